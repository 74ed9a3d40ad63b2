"""Quality rules by n-gram perplexity.

Character n-grams of all documents are counted with Spark and turned into a modified Kneser-Ney model for each language.
The model lies in sorted arrays of 64-bit hashes. A document's perplexity is that of its whole text, spent per letter or
digit, so that text padded with symbols or separators costs more. Documents outside the band of their language go.

Defined cases: null text is empty; null languages form one language of their own; empty tables give empty results; a
document without letters has no perplexity and is not kept; repeated rows are scored and kept each; columns of the input
named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import STEP, Texts, fresh, mixed, runs, shared_place
from tallymark.session import attach, scratch_path, written

ORDER = 5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Width of the band above and below the median, in quartile ranges, and its least width as a share of the median.
UPPER, LOWER, LEAST = 4.5, 6.5, 0.1
#: Model rows of one shard, about 100 bytes each for the task that finishes it. Rows behind one pair of characters stay together.
SHARD_ROWS = 250_000
#: Model rows that a scoring task holds at once, 24 bytes each; of a larger model it takes a part after the other.
HOLD_ROWS = 4_000_000
#: Text bytes that a task gathers before it goes through the parts of such a model.
GATHER_BYTES = 32 << 20
#: Distinct n-grams that a counting task gathers before it hands them on.
GATHER = 1_000_000
#: Log probability of a character in a language that the model has never seen.
UNSEEN = math.log(1e-6)

PAD = 2
_ORDER_STEP = np.multiply.accumulate(np.full(8, STEP ^ np.uint64(0x5851F42D4C957F2C), np.uint64))
_ALNUM = np.array([chr(c).isalnum() for c in range(1 << 16)])
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def char_hash(code: np.ndarray) -> np.ndarray:
    return mixed(code.astype(np.uint64) * STEP + np.uint64(1))


def language_seed(name: str) -> np.uint64:
    seed = np.uint64(len(name) + 7)
    for code in name.encode():
        seed = mixed(np.array([seed ^ np.uint64(code)], np.uint64))[0]
    return seed


def kind_seed(order: int, backoff: bool = False) -> np.uint64:
    return mixed(np.array([order + 64 * backoff + 1], np.uint64))[0]


class Characters:
    """Code points of a slice of texts, white space runs as one space, ORDER - 1 pads before each document."""

    def __init__(self, texts: Texts, order: int):
        points = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        heads = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80, dtype=np.int64)))
        bounds = heads[texts.offsets]
        space = (points == 32) | ((points >= 9) & (points <= 13))
        keep = ~space
        keep[1:] |= ~space[:-1]
        first = bounds[:-1][bounds[:-1] < len(points)]
        keep[first] = ~space[first]
        kept = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
        sizes = np.diff(kept[bounds])
        doc = np.repeat(np.arange(texts.n), sizes)
        self.doc = doc
        self.at = np.arange(len(doc)) + (order - 1) * (doc + 1)
        self.padded = np.full(len(doc) + (order - 1) * texts.n, PAD, np.uint32)
        self.padded[self.at] = np.maximum(np.where(space, 32, points)[keep], 1)
        self.n, self.sizes, self.order = texts.n, sizes, order
        letters = self.padded[self.at]
        self.letters = np.bincount(doc[(letters >> 16 > 0) | _ALNUM[letters & 0xFFFF]], minlength=texts.n)
        self.codes = char_hash(self.padded)

    def hashes(self, order: int, at: np.ndarray, back: int = 0) -> np.ndarray:
        """Hash of the ``order`` characters that end ``back`` before each position."""
        out = np.zeros(len(at), np.uint64)
        for j in range(order):
            out += self.codes[at - (back + j)] * _ORDER_STEP[j]
        return out


def base_measures(texts: Texts) -> dict[str, np.ndarray]:
    """The plain measures of the texts: see BASE."""
    starts, word, doc = texts.words()
    n = texts.per_document(doc)
    data = texts.data
    inside = (data != 32) & ((data < 9) | (data > 13))
    chars = texts.sums(inside & ((data & 0xC0) != 0x80))
    repeated = np.zeros(len(word) + 2, bool)
    if len(word) > 2:
        same = doc[2:] == doc[:-2]
        at = np.flatnonzero(same)
        tri = mixed((word[at] * STEP + word[at + 1]) * STEP + word[at + 2])
        order, first, size = runs(mixed(tri ^ mixed(doc[at].astype(np.uint64) + STEP)))
        hit = at[order[np.repeat(size > 1, size)]]
        for j in range(3):
            repeated[hit + j] = True
    n_repeat = texts.per_document(doc, repeated[: len(word)]) if len(word) else np.zeros(texts.n, np.int64)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": texts.sums(_SYMBOL[data]),
        "n_dup_lines": duplicate_lines(texts, starts, doc), "n_repeat_words": n_repeat,
    }


def duplicate_lines(texts: Texts, word_starts: np.ndarray, word_doc: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document."""
    from tallymark.llm.common import segment_hash

    data = texts.data
    if not len(word_starts):
        return np.zeros(texts.n, np.int64)
    begins = np.zeros(len(data), bool)
    begins[1:] = data[:-1] == 10
    begins[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    line = segment_hash(data, starts, data != 10)
    with_word = np.unique(np.searchsorted(starts, word_starts, side="right") - 1)
    doc = np.searchsorted(texts.offsets, starts[with_word], side="right") - 1
    order, first, _ = runs(mixed(line[with_word] ^ mixed(doc.astype(np.uint64) + STEP)))
    return texts.per_document(doc) - texts.per_document(doc[order[first]])


def languages_of(batch: pa.RecordBatch, lang: str) -> tuple[np.ndarray, list[str]]:
    coded = batch.column(lang).cast(pa.string()).fill_null("").dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary.to_pylist()


def counter(lang: str, text: str, order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches):
        keys, langs, grams, sums = np.zeros(0, np.uint64), np.zeros(0, object), np.zeros((0, order), np.uint32), np.zeros(0, np.int64)

        def out():
            strings = np.ascontiguousarray(grams).view(f"<U{order}").ravel()
            return pa.record_batch([pa.array(langs, pa.string()), pa.array(strings.tolist(), pa.string()), pa.array(sums)], names=["lang", "gram", "n"])

        for batch in batches:
            index, names = languages_of(batch, lang)
            seeds = np.array([language_seed(x) for x in names], np.uint64)
            for texts in Texts.slices(batch.column(text)):
                chars = Characters(texts, order)
                if not len(chars.at):
                    continue
                of = index[texts.first : texts.first + texts.n][chars.doc]
                h = chars.hashes(order, chars.at) ^ seeds[of]
                u, where, c = np.unique(h, return_index=True, return_counts=True)
                at = chars.at[where]
                keys = np.concatenate((keys, u))
                langs = np.concatenate((langs, np.array(names, object)[of[where]]))
                grams = np.concatenate((grams, np.stack([chars.padded[at - (order - 1) + j] for j in range(order)], 1)))
                keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
                langs, grams = langs[first], grams[first]
                sums = np.bincount(inverse, weights=np.concatenate((sums, c)), minlength=len(keys)).astype(np.int64)
                if len(keys) > GATHER:
                    yield out()
                    keys, langs, grams, sums = keys[:0], langs[:0], grams[:0], sums[:0]
        if len(keys):
            yield out()

    return count


def gram_counts(docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER) -> DataFrame:
    """How often each character n-gram of the highest order occurs in each language, over all documents."""
    parts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).mapInArrow(
        counter("lang", "text", order), "lang string, gram string, n bigint"
    )
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """Modified Kneser-Ney terms of all orders from counts of the highest: lang, k, gram, own, gamma.

    The probability of a gram is ``own`` + ``gamma`` x that of the gram without its first character. Lower orders count in
    how many different longer n-grams an n-gram ends. A context has no more continuations than there are characters, so the
    windows over contexts stay small.
    """
    counts = written(counts)
    longer = F.explode(F.transform(F.sequence(F.lit(2), F.lit(order)), lambda k: F.struct(k.alias("k"), F.substring(F.col("gram"), order + 1 - k, k).alias("longer"))))
    ends = counts.select("lang", longer.alias("s")).select("lang", "s.k", "s.longer").distinct()
    lower = ends.groupBy("lang", (F.col("k") - 1).alias("k"), F.expr("substring(longer, 2)").alias("gram")).agg(F.count("*").alias("n"))
    levels = written(counts.select("lang", F.lit(order).alias("k"), "gram", "n").unionByName(lower))
    seen = [F.count_if(F.col("n") == j).cast("double").alias(f"n{j}") for j in (1, 2, 3, 4)]
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))
    discounts = [
        F.when(F.col(f"n{j}") > 0, F.greatest(F.lit(0.05 * j), F.least(F.lit(0.95 * j), j - (j + 1) * y * F.col(f"n{j + 1}") / F.col(f"n{j}")))).otherwise(F.lit(0.5 * j)).alias(f"d{j}")
        for j in (1, 2, 3)
    ]
    rows = attach(levels, levels.groupBy("lang", "k").agg(*seen).select("lang", "k", *discounts), ["lang", "k"])
    rows = rows.withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
    around = Window.partitionBy("lang", "k", F.expr("substring(gram, 1, k - 1)"))
    total = F.sum("n").over(around)
    return rows.select("lang", "k", "gram", ((F.col("n") - F.col("d")) / total).alias("own"), (F.sum("d").over(around) / total).alias("gamma"))


ROW = "k int, key bigint, suffix bigint, context bigint, own double, gamma double, cut bigint"


def pair_cut(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """31-bit number of a pair of characters, from their hashes."""
    return mixed(last + before * STEP) >> np.uint64(33)


def hashed(rows: DataFrame, order: int) -> DataFrame:
    """The rows by hash: of the gram, of what it backs off to and of its context; ``cut`` tells the shard (-1: every one).

    A shard holds what belongs to some pairs of characters before the last, so that backing off never leaves it; grams of
    one or two characters are in all.
    """

    def keys(batches):
        for batch in batches:
            index, names = languages_of(batch, "lang")
            seeds = np.array([language_seed(x) for x in names] or [0], np.uint64)[index]
            ks, out = np.asarray(batch.column("k")), np.zeros((4, batch.num_rows), np.uint64)
            grams = np.array(batch.column("gram").to_pylist(), object)
            for k in range(1, order + 1):
                at = np.flatnonzero(ks == k)
                if not len(at):
                    continue
                codes = np.array(grams[at].tolist(), f"<U{k}").view(np.uint32).reshape(-1, k)
                c = char_hash(codes.ravel()).reshape(codes.shape)
                whole, shorter, before = (sum((c[:, e - j] * _ORDER_STEP[j] for j in range(n)), np.zeros(len(at), np.uint64)) for e, n in ((k - 1, k), (k - 1, k - 1), (k - 2, k - 1)))
                out[0, at] = mixed(whole ^ seeds[at] ^ kind_seed(k))
                out[1, at] = mixed(shorter ^ seeds[at] ^ kind_seed(k - 1))
                out[2, at] = mixed(before ^ seeds[at] ^ kind_seed(k - 1, True))
                out[3, at] = pair_cut(c[:, k - 2], c[:, k - 3]) if k > 2 else np.uint64(2**64 - 1)
            yield pa.record_batch(
                [batch.column("k").cast(pa.int32()), *[pa.array(out[i].view(np.int64)) for i in range(3)], batch.column("own"), batch.column("gamma"), pa.array(out[3].view(np.int64))],
                names=["k", "key", "suffix", "context", "own", "gamma", "cut"],
            )

    return rows.mapInArrow(keys, ROW)


class HashArray:
    """Values by 64-bit hash: sorted keys with an index on their leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = np.append(keys[order], np.uint64(2**64 - 1)), np.append(values[order], np.float32(np.nan))
        bits = max(4, min(22, int(len(keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(keys[order], np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The values, NaN for keys that are not there."""
        at = self.begin[(wanted >> self.shift).astype(np.int64)]
        open_ = np.flatnonzero(self.keys[at] < wanted)
        while len(open_):
            at[open_] += 1
            open_ = open_[self.keys[at[open_]] < wanted[open_]]
        return np.where(self.keys[at] == wanted, self.values[at], np.float32(np.nan))


def log_likelihood(chars: Characters, seeds: np.ndarray, model: HashArray, part: range, shards: int) -> np.ndarray:
    """Sum of the log probabilities of each document's characters that belong to the shards in ``part``."""
    at, doc = chars.at, chars.doc
    if len(part) < shards:
        shard = (pair_cut(chars.codes[at - 1], chars.codes[at - 2]) % np.uint64(shards)).astype(np.int64)
        own = (shard >= part.start) & (shard < part.stop)
        at, doc = at[own], doc[own]
    seed = seeds[doc]
    total, todo = np.zeros(len(at)), np.arange(len(at))
    for k in range(chars.order, -1, -1):
        h = chars.hashes(k, at[todo]) if k else np.zeros(len(todo), np.uint64)
        value = model.find(mixed(h ^ seed[todo] ^ kind_seed(k)))
        found = ~np.isnan(value)
        total[todo[found]] += value[found]
        todo = todo[~found]
        if not len(todo):
            break
        if k:
            gamma = model.find(mixed((chars.hashes(k - 1, at[todo], 1) if k > 1 else np.zeros(len(todo), np.uint64)) ^ seed[todo] ^ kind_seed(k - 1, True)))
            total[todo] += np.where(np.isnan(gamma), 0, gamma)
    total[todo] += UNSEEN
    return np.bincount(doc, weights=total, minlength=chars.n)


def finisher(order: int) -> Callable[[pa.Table], pa.Table]:
    """The log probabilities and backoff weights of one shard, from its rows."""

    def finish(rows: pa.Table) -> pa.Table:
        k, key, suffix, context, own, gamma = (rows.column(c).to_numpy() for c in ("k", "key", "suffix", "context", "own", "gamma"))
        empty, characters = np.unique(suffix[k == 1], return_counts=True)
        keys, values = [empty], [1.0 / (characters + 1)]
        for i in range(1, order + 1):
            at = k == i
            by_key = np.argsort(keys[-1])
            shorter = values[-1][by_key][np.searchsorted(keys[-1], suffix[at], sorter=by_key)]
            keys.append(key[at])
            values.append(own[at] + gamma[at] * shorter)
        known, first = np.unique(context, return_index=True)
        keys = np.concatenate([*keys, known]).view(np.uint64)
        values = np.log(np.concatenate([*values, gamma[first]])).astype(np.float32)
        by_key = np.argsort(keys)
        cells = {"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "keys": pa.array([keys[by_key].tobytes()], pa.binary()), "logs": pa.array([values[by_key].tobytes()], pa.binary())}
        return pa.table(cells)

    return finish


_HELD: dict[tuple, HashArray] = {}


def held_part(path: str, part: range) -> HashArray:
    """The hash array of some shards; a worker keeps the last one."""
    if (path, part) not in _HELD:
        _HELD.clear()
        files, place = shared_place(path)
        found = ds.dataset(place, filesystem=files, format="parquet").to_table(filter=(ds.field("shard") >= part.start) & (ds.field("shard") < part.stop))
        keys = np.frombuffer(b"".join(found.column("keys").to_pylist()), np.uint64)
        _HELD[path, part] = HashArray(keys, np.frombuffer(b"".join(found.column("logs").to_pylist()), np.float32))
    return _HELD[path, part]


class Perplexity:
    """A fitted model: tables of hashed rows and of finished shards (sorted hash arrays) in the shared folder.

    Every shard is finished by one task from its rows; the driver only counts. Tasks read the shards as they need them.
    """

    def __init__(self, rows: DataFrame, order: int, shard_rows: int = SHARD_ROWS, hold_rows: int = HOLD_ROWS):
        self.rows, self.order = rows, order
        self.shards = max(1, -(-rows.filter("cut >= 0").count() // shard_rows))
        each = max(1, hold_rows // shard_rows)
        self.parts = [range(i, min(i + each, self.shards)) for i in range(0, self.shards, each)]
        dealt = F.when(F.col("cut") < 0, F.sequence(F.lit(0), F.lit(self.shards - 1))).otherwise(F.array((F.col("cut") % self.shards).cast("int")))
        dealt = rows.select("k", "key", "suffix", "context", "own", "gamma", F.explode(dealt).alias("shard"))
        self.path = scratch_path(rows.sparkSession, "model")
        dealt.groupBy("shard").applyInArrow(finisher(order), "shard int, keys binary, logs binary").write.parquet(self.path)

    @classmethod
    def fit(cls, docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, shard_rows: int = SHARD_ROWS) -> Perplexity:
        return cls(written(hashed(kneser_ney(gram_counts(docs, text, lang, order), order), order)), order, shard_rows)

    def score(self, docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None) -> DataFrame:
        """The columns in ``carry`` (all by default), the measures of BASE, and ``nats``: what the text costs per letter.

        One pass over the texts, whatever the size of the model.
        """
        carry = fresh(docs, *BASE, "nats").columns if carry is None else carry
        own = text if text in carry else "__text"  # a text that is carried anyway goes to the tasks once
        extra = [] if text in carry else [F.col(text).alias("__text")]
        df = docs.select(*[F.col(f"`{c}`") for c in carry], *extra, F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("__lang"))
        fields = {f.name: f for f in df.schema.fields}
        schema = T.StructType([fields[c] for c in carry] + [T.StructField(c, T.LongType()) for c in BASE] + [T.StructField("nats", T.DoubleType())])
        return df.mapInArrow(scorer(self.path, self.parts, self.shards, own, self.order, carry), schema)


def gathered(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[list[pa.RecordBatch]]:
    """The batches in runs that hold at least ``most`` bytes of text, but for the last one."""
    run, size = [], 0
    for batch in batches:
        run.append(batch)
        size += batch.column(text).nbytes
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def scorer(path: str, parts: list[range], shards: int, text: str, order: int, carry: list[str]):
    """text: the column with the text. carry: the columns that stay."""

    def score(batches):
        for run in gathered(batches, text, GATHER_BYTES if len(parts) > 1 else 0):
            totals = [np.zeros(batch.num_rows) for batch in run]
            measures = [{c: np.zeros(batch.num_rows, np.int64) for c in (*BASE, "letters")} for batch in run]
            for number, part in enumerate(parts):
                model = held_part(path, part)
                for batch, total, measure in zip(run, totals, measures):
                    index, langs = languages_of(batch, "__lang")
                    seeds = np.array([language_seed(x) for x in langs] or [0], np.uint64)[index]
                    for texts in Texts.slices(batch.column(text)):
                        chars, rows = Characters(texts, order), slice(texts.first, texts.first + texts.n)
                        total[rows] += log_likelihood(chars, seeds[rows], model, part, shards)
                        if number == 0:
                            measure["letters"][rows] = chars.letters
                            for c, values in base_measures(texts).items():
                                measure[c][rows] = values
            for batch, total, measure in zip(run, totals, measures):
                letters = measure.pop("letters")
                nats = pa.array(-total / np.maximum(letters, 1), pa.float64(), mask=letters == 0)
                yield pa.record_batch([*[batch.column(c) for c in carry], *[pa.array(measure[c]) for c in BASE], nats], names=[*carry, *BASE, "nats"])

    return score


def base_failed() -> Column:
    """Fewer than MIN_WORDS words, or over MAX_REPEAT_PERCENT of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bands(scored: DataFrame, upper: float = UPPER, lower: float = LOWER, least: float = LEAST) -> DataFrame:
    """Lowest and highest cost of each language, from all scored documents that pass the base rules."""
    q = F.percentile_approx("nats", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10_000))
    found = scored.filter(~F.col("base_failed") & F.col("nats").isNotNull()).groupBy("__lang").agg(q.alias("q"))
    iqr, mid = F.col("q")[2] - F.col("q")[0], F.col("q")[1]
    return found.select("__lang", (mid - F.greatest(lower * iqr, least * mid)).alias("__low"), (mid + F.greatest(upper * iqr, least * mid)).alias("__high"))


def quality_rules(
    docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None, model: Perplexity | None = None,
    upper: float = UPPER, lower: float = LOWER, least: float = LEAST,
) -> DataFrame:
    """Measures and verdict of every document.

    Adds the columns of BASE, ``perplexity`` (per letter), ``base_failed`` and ``kept`` to those in ``carry`` (all by
    default). Without a ``model``, one is fitted to ``docs``. The scored rows are written once; bands are taken from them.
    """
    model = model or Perplexity.fit(docs, text, lang)
    carry = fresh(docs, *BASE, "nats", "perplexity", "base_failed", "kept").columns if carry is None else carry
    with_lang = docs.withColumn("__own_lang", F.coalesce(F.col(lang).cast("string"), F.lit("")))
    scored = written(model.score(with_lang, text, lang, [*carry, "__own_lang"]).withColumn("base_failed", base_failed()))
    scored = scored.withColumnRenamed("__own_lang", "__lang")
    limits = bands(scored, upper, lower, least)
    kept = ~F.col("base_failed") & F.coalesce((F.col("nats") >= F.col("__low")) & (F.col("nats") <= F.col("__high")), F.lit(False))
    return attach(scored, limits, ["__lang"]).select(
        *[F.col(f"`{c}`") for c in carry], *BASE, F.exp("nats").alias("perplexity"), "base_failed", kept.alias("kept")
    )
