"""Near-duplicate documents by min-max hashing.

Each document's set of word shingles is hashed with pseudo-random multipliers; of every multiplier both the smallest and
the largest value are kept, so one pass gives two signature values. Bands of the signature bring similar documents
together and every link is confirmed on the full sets.

Equal sets are one class first, and only class representatives (smallest id) are banded. In each band's bucket the
members are compared with the bucket's smallest id. Members of a bucket that are not connected after that are compared
with each other, unless what they can have in common is too little for a link: shingles that no other such member has
don't count, nor do those whose places in a bitmap of the other set are empty. So no link between documents that share
a band is lost, while large groups of copies cost one comparison a member.

Defined cases: null, empty and wordless texts have no shingles and are linked with nothing; null ids too; rows that
repeat an id are compared each by its own text and share the id; an empty table gives an empty result; columns of the
input named like an output are replaced. ``drop_near_duplicates`` keeps one row of each group, that of the smallest id;
copies with a null id go with their text's group, and all rows without shingles stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import STEP, Texts, ascii_lower, fresh, mixed
from tallymark.session import written

#: 48 bands of 6 values: a pair of similarity 0.8 shares a band but for a chance of 5e-7, one of 0.2 with one of 0.003.
BANDS, ROWS = 48, 6
WORDS = 4
PERCENT = 80
#: Shingles of one range in the count of shared shingles.
RANGE_SHINGLES = 2_000_000
#: 64-bit words of the bitmap of a set's shared shingles.
MAP_WORDS = 16

_MULTIPLIERS = np.random.Generator(np.random.PCG64(77)).integers(0, 2**31, BANDS * ROWS // 2, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, those of a text sorted and together, and where each text's begin."""
    _, word, doc = texts.words(ascii_lower(texts.data))
    count = texts.per_document(doc)
    short = np.minimum(count, words)
    heads = np.cumsum(count) - count
    number = np.where(count > 0, count - short + 1, 0)
    which = np.repeat(np.arange(texts.n), number)
    at = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number) + heads[which]
    h = np.zeros(len(at), np.uint64)
    for j in range(words):
        inside = j < short[which]
        h = np.where(inside, mixed(h * STEP + word[np.minimum(at + j, max(len(word) - 1, 0))] + np.uint64(j + 1)), h) if len(word) else h
    order = np.lexsort((h, which))
    h, which = h[order], which[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (which[1:] != which[:-1])
    h, which = h[new], which[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(which, minlength=texts.n))))


def signatures(h: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys (documents x bands) of the non-empty sets; rows of empty sets are meaningless."""
    n = len(bounds) - 1
    keys = np.zeros((n, bands), np.uint64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return keys
    starts, h32 = bounds[full], (h >> np.uint64(32)).astype(np.uint32)
    for b in range(bands):
        key = np.full(len(full), b + 1, np.uint64)
        for m in _MULTIPLIERS[b * rows // 2 : (b + 1) * rows // 2]:
            value = h32 * m
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            key = mixed(key * STEP + np.minimum.reduceat(value, starts))
            key = mixed(key * STEP + np.maximum.reduceat(value, starts))
        keys[full, b] = key
    return keys


def signed(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, t, n_shingles, two digests of the set, and the band keys, from columns id, t (hash of the text) and text."""

    def sign(batches):
        for batch in batches:
            size, d1, d2, keys = [], [], [], []
            for texts in Texts.slices(batch.column("text")):
                h, bounds = shingle_sets(texts, words)
                size.append(np.diff(bounds))
                for out, salt in ((d1, np.uint64(3)), (d2, np.uint64(5))):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(h * salt + salt), dtype=np.uint64)))
                    out.append(total[bounds[1:]] - total[bounds[:-1]])
                keys.append(signatures(h, bounds, bands, rows))
            if not size:
                continue
            n, keys = np.concatenate(size), np.concatenate(keys)
            flat = pa.array(keys.ravel().view(np.int64))
            offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands)
            yield pa.record_batch(
                [batch.column("id"), batch.column("t"), pa.array(n), pa.array(np.concatenate(d1).view(np.int64)), pa.array(np.concatenate(d2).view(np.int64)), pa.ListArray.from_arrays(offsets, flat)],
                names=["id", "t", "n_shingles", "d1", "d2", "bands"],
            )

    return docs.mapInArrow(sign, "id bigint, t bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>")


def packed_sets(docs: DataFrame, words: int) -> DataFrame:
    """The shingle sets themselves, as sorted 64-bit numbers in a binary column."""

    def pack(batches):
        for batch in batches:
            out = []
            for texts in Texts.slices(batch.column("text")):
                h, bounds = shingle_sets(texts, words)
                out += [h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.record_batch([batch.column("node"), pa.array(out, pa.binary())], names=["node", "members"])

    return docs.select("node", "text").mapInArrow(pack, "node bigint, members binary")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))

    def compare(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                shared = np.count_nonzero(both[1:] == both[:-1])
                good[i] = 100 * shared >= percent * (len(both) - shared)
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(compare, "a bigint, b bigint")


def shared_counts(sets: DataFrame) -> DataFrame:
    """For each set, how many of its members are in at least one other set, and a bitmap of those (m0, m1, ..).

    The sets are cut into ranges of the hash; each range is counted as packed arrays.
    """
    names = [f"m{i}" for i in range(MAP_WORDS)]
    total = sets.agg(F.sum(F.octet_length("members"))).first()[0] or 0
    ranges = max(1, -(-total // 8 // RANGE_SHINGLES))

    def cut(batches):
        for batch in batches:
            nodes, places, parts = [], [], []
            for node, members in zip(batch.column("node").to_pylist(), batch.column("members")):
                h = np.frombuffer(members.as_buffer(), np.uint64)
                place = ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                at = np.concatenate((np.flatnonzero(np.diff(place, prepend=-1)), [len(h)]))
                for s, e in zip(at[:-1], at[1:]):
                    nodes.append(node)
                    places.append(int(place[s]))
                    parts.append(h[s:e].tobytes())
            yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(places, pa.int64()), pa.array(parts, pa.binary())], names=["node", "place", "part"])

    def count(table: pa.Table) -> pa.Table:
        sizes = np.array([len(x) // 8 for x in table.column("part").to_pylist()])
        h = np.frombuffer(b"".join(table.column("part").to_pylist()), np.uint64)
        _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
        often = times[inverse] > 1
        row = np.repeat(np.arange(len(sizes)), sizes)[often]
        bit = (h[often] >> np.uint64(8)) % np.uint64(64 * MAP_WORDS)
        maps = np.zeros((len(sizes), MAP_WORDS), np.uint64)
        np.bitwise_or.at(maps, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
        out = {"node": table.column("node"), "shared": pa.array(np.bincount(row, minlength=len(sizes)).astype(np.int64))}
        return pa.table(out | {m: pa.array(np.ascontiguousarray(maps[:, i]).view(np.int64)) for i, m in enumerate(names)})

    parts = sets.mapInArrow(cut, "node bigint, place bigint, part binary")
    counted = parts.groupBy("place").applyInArrow(count, "node bigint, shared bigint, " + ", ".join(f"{m} bigint" for m in names))
    return counted.groupBy("node").agg(F.sum("shared").alias("shared"), *[F.bit_or(m).alias(m) for m in names])


def components(edges: DataFrame) -> DataFrame:
    """node and the smallest node that can be reached from it, for the nodes of edges (a, b)."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("further"))
        step = written(step.join(jump, "new").select("node", "label", F.least("new", "further").alias("new")))
        changed = step.filter(F.col("new") != F.col("label")).limit(1).count()
        labels = step.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def grouped(docs: DataFrame, key: str, text: str, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Per row: id, t (hash of the text), n_shingles, d1, d2, label of the group and its least id (both null for rows without shingles and texts without an id)."""
    base = docs.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    marks = written(signed(base, words, bands, rows))
    usable = marks.filter(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    # A class is named by the digests of its set, and stands for its row with the smallest id.
    classes = usable.groupBy("d1", "d2", "n_shingles").agg(F.min(F.struct("id", "t")).alias("first"))
    classes = written(classes.select(F.xxhash64("d1", "d2").alias("node"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), "first.id", "first.t"))
    firsts = classes.select("node", "e1", "e2", F.col("id").alias("f_id"), F.col("t").alias("f_t"))
    nodes = usable.join(firsts, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))).filter((F.col("id") == F.col("f_id")) & (F.col("t") == F.col("f_t")))
    nodes = nodes.select("node", "n_shingles", "bands")
    each = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    hubs = each.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top"), F.min(F.struct("node", "n_shingles")).alias("first"))
    hubs = hubs.filter(F.col("hub") < F.col("top")).select("bucket", "hub", F.col("first.n_shingles").alias("hub_n"))
    members = written(each.join(hubs, "bucket").select("bucket", "hub", "hub_n", "node", "n_shingles"))

    # Texts of the nodes that share a bucket with another one.
    wanted = firsts.join(members.select("node").distinct(), "node").select("node", "f_id", "f_t")
    source = base.join(wanted, (F.col("id") == F.col("f_id")) & (F.col("t") == F.col("f_t"))).select("node", "text")
    sets = written(packed_sets(source, words).filter(F.octet_length("members") > 0))

    def possible(n, m, both):
        """Could sets of n and m members with at most ``both`` in common be linked?"""
        return 100 * both >= percent * (n + m - both)

    star = members.filter((F.col("node") != F.col("hub")) & possible(F.col("hub_n"), F.col("n_shingles"), F.least("hub_n", "n_shingles")))
    star = written(linked(star.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), sets, percent))
    groups = components(star)

    placed = members.join(groups, "node", "left").select("bucket", "node", "n_shingles", F.coalesce("label", "node").alias("label"))
    mixed_up = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("bucket")
    rest = written(placed.join(mixed_up, "bucket"))
    shared = shared_counts(sets.join(rest.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))
    rest = written(rest.join(shared, "node").filter(possible(F.col("n_shingles"), F.col("shared"), F.col("shared"))))
    other = rest.select(*[F.col(c).alias(f"{c}_") for c in rest.columns])
    only = [sum((F.bit_count(F.col(f"m{i}{x}").bitwiseAND(F.bitwise_not(f"m{i}{y}"))) for i in range(1, MAP_WORDS)), F.bit_count(F.col(f"m0{x}").bitwiseAND(F.bitwise_not(f"m0{y}")))) for x, y in (("", "_"), ("_", ""))]
    both = F.least(F.col("shared") - only[0], F.col("shared_") - only[1])
    cross = rest.join(
        other, (F.col("bucket") == F.col("bucket_")) & (F.col("label") != F.col("label_")) & (F.col("node") < F.col("node_")) & possible(F.col("n_shingles"), F.col("n_shingles_"), both)
    ).select(F.col("node").alias("a"), F.col("node_").alias("b")).distinct()
    groups = components(star.unionByName(written(linked(cross, sets, percent))))

    named = classes.join(groups, "node", "left").select("e1", "e2", "id", F.coalesce("label", "node").alias("label"))
    lowest = named.groupBy(F.col("label").alias("of")).agg(F.min("id").alias("component_id"))
    final = named.join(lowest, F.col("label") == F.col("of")).select("e1", "e2", "label", "component_id")
    return marks.select("id", "t", "n_shingles", "d1", "d2").join(final, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left").drop("e1", "e2")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """Per row: key, n_shingles, component_id, kept."""
    out = grouped(docs, key, text, words, percent, bands, rows)
    component = F.when(F.col("id").isNull() | (F.col("n_shingles") == 0), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """``docs`` with one row of each group: the smallest key, then one of its texts. Rows are told apart by key and text."""
    found = written(grouped(docs, key, text, words, percent, bands, rows).filter("n_shingles > 0"))
    # A text that only rows without an id have is a group of its own.
    group = [F.coalesce("label", "d1"), F.when(F.col("label").isNull(), F.col("d2"))]
    each = found.groupBy(group[0].alias("g1"), group[1].alias("g2"), "id", "t").agg(F.count("*").alias("n"))
    each = written(each.groupBy("g1", "g2").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "t", "n")).alias("best")))
    best = each.select("g1", "g2", F.col("best.id").alias("b_id"), F.col("best.t").alias("b_t"), F.col("best.n").alias("b_n"))
    same = F.col("id").eqNullSafe(F.col("b_id")) & (F.col("t") == F.col("b_t"))
    gone = found.select("id", "t", group[0].alias("h1"), group[1].alias("h2")).join(best, (F.col("g1") == F.col("h1")) & F.col("g2").eqNullSafe(F.col("h2")))
    gone = gone.filter(~same).select(F.col("id").alias("__id"), F.col("t").alias("__t")).distinct()
    own = lambda df: F.col(key).cast("bigint").eqNullSafe(df["__id"]) & (F.xxhash64(text) == df["__t"])
    kept = docs.join(gone, own(gone), "left_anti")
    twice = best.filter("b_n > 1").select(F.col("b_id").alias("__id"), F.col("b_t").alias("__t"))
    if twice.isEmpty():
        return kept
    one = kept.join(twice, own(twice), "left_semi").withColumn("__t", F.xxhash64(text)).dropDuplicates([key, "__t"]).drop("__t")
    return kept.join(twice, own(twice), "left_anti").unionByName(one)
