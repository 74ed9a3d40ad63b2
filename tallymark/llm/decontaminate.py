"""Benchmark decontamination: word windows of test items, found in training documents and removed from them.

The distinct windows of all items are a set of hashes that is broadcast when its size is proven small and joined by
shuffle when it is not. Each document's windows are hashed where the document is read; every hit is verified on its words.

Defined cases: null text has no words; items without words are ignored; null document ids are kept; equal rows get equal
results, one each; empty tables give empty results or documents without hits; columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fresh

WINDOW = 10
#: Most windows whose hashes and words are broadcast, and the longest window in bytes among them.
BROADCAST_WINDOWS = 200_000
BROADCAST_BYTES = 1_000

ENTRIES = "array<struct<length:int,start:int,hash:bigint>>"
_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split(text: Column) -> Column:
    """Words of a text whose capital A to Z don't matter yet; a capital is a word character as its small letter is."""
    return F.filter(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")


def words(text: Column) -> Column:
    """Words after A to Z are lower-cased."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), f"{_OTHER}+"), lambda w: w != "")


def _windows(folded: Column, length: int) -> Column:
    """Length, place (from 1) and hash of each window of ``length`` words."""
    n = F.size(folded) - length + 1
    each = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(F.lit(length).alias("length"), i.alias("start"), F.xxhash64(F.slice(folded, i, length)).alias("hash")),
    )
    return F.when(n > 0, each).otherwise(F.array().cast(ENTRIES))


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: hash of the case-folded words, the words, how many, and the items that hold them."""
    w = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    w = w.withColumn("length", F.least(F.size("w"), F.lit(window)))
    w = w.select("item", "length", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1), lambda i: F.slice("w", i, F.col("length")))).alias("w"))
    w = w.groupBy(F.array_join("w", " ").alias("words"), "length").agg(F.collect_set("item").alias("items"), F.first("w").alias("w"))
    return w.select(F.xxhash64(F.transform("w", F.upper)).alias("hash"), "words", "length", "items")


def hits(docs: DataFrame, windows: DataFrame, text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """One row for each document (start 0, no items) and for each window found in it (start from 1, length, items).

    Documents are named by ``keys``, which are expressions over ``docs`` already among its columns.
    """
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())
    bound = windows.agg(F.count("*").alias("n"), F.max(F.octet_length("words")).alias("bytes"), F.max(F.size("items")).alias("items")).first()
    small = bound["n"] <= BROADCAST_WINDOWS and (bound["bytes"] or 0) <= BROADCAST_BYTES and (bound["items"] or 0) <= 1_000
    df = docs.select(*keys, _split(F.col(text)).alias("w"), _split(F.upper(F.col(text))).alias("folded"))
    df = df.select(*keys, "w", F.greatest(F.coalesce(F.size("w"), F.lit(0)), F.lit(0)).alias("n_words"), *[_windows(F.col("folded"), k).alias(f"h{k}") for k in lengths])
    head = F.array(F.struct(F.lit(0).alias("length"), F.lit(0).alias("start"), F.lit(0).cast("bigint").alias("hash")))
    each = F.concat(head, *[F.coalesce(F.col(f"h{k}"), F.array().cast(ENTRIES)) for k in lengths])
    df = df.select(*keys, "w", "n_words", F.explode(each).alias("e"))
    spark = docs.sparkSession
    known = windows.select("hash", "words", "length", "items")
    nothing = spark.range(1).select(F.lit(0).cast("bigint").alias("hash"), F.lit("").alias("words"), F.lit(0).alias("length"), F.array().cast(windows.schema["items"].dataType).alias("items"))
    known = known.unionByName(nothing)
    known = known.select(F.col("hash").alias("k_hash"), F.col("length").alias("k_length"), "words", "items")
    match = (F.col("e.hash") == F.col("k_hash")) & (F.col("e.length") == F.col("k_length"))
    exact = (F.col("e.length") == 0) | (F.translate(F.array_join(F.slice("w", F.greatest(F.col("e.start"), F.lit(1)), F.col("e.length")), " "), _UPPER, _LOWER) == F.col("words"))
    if not small:  # the words of a hit travel only with the rows of the shuffled join
        df = df.withColumn("w", F.slice("w", F.greatest(F.col("e.start"), F.lit(1)), F.col("e.length"))).withColumn("e", F.struct("e.length", "e.start", "e.hash"))
        exact = (F.col("e.length") == 0) | (F.translate(F.array_join("w", " "), _UPPER, _LOWER) == F.col("words"))
        return df.join(known, match).filter(exact).select(*keys, "n_words", F.col("e.start").alias("start"), F.col("e.length").alias("length"), "items")
    return df.join(F.broadcast(known), match).filter(exact).select(*keys, "n_words", F.col("e.start").alias("start"), F.col("e.length").alias("length"), "items")


def merged(spans: Column) -> Column:
    """Union of sorted (start, length) spans as an array of (start, stop), stop exclusive."""
    kind = "array<struct<start:int,stop:int>>"
    return F.aggregate(
        spans, F.array().cast(kind),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= s["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], s["start"] + s["length"]).alias("stop"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), (s["start"] + s["length"]).alias("stop"))))).cast(kind),
    )


def covered(spans: Column) -> Column:
    """Number of words inside sorted (start, length) spans."""
    state = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("stop"))
    return F.aggregate(
        spans, state,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["start"] + s["length"] - F.greatest(acc["stop"], s["start"].cast("bigint")))).alias("n"),
            F.greatest(acc["stop"], (s["start"] + s["length"]).cast("bigint")).alias("stop"),
        ),
        lambda acc: acc["n"],
    )


def found(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document row: key, n_words, n_hit, n_items, items (sorted as strings), contaminated, spans of hit words."""
    named = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).withColumn("__digest", F.xxhash64("__text"))
    h = hits(named, item_windows(benchmark, item, item_text, window), "__text", ["__key", "__digest"])
    real = F.col("start") > 0
    per = h.groupBy("__key", "__digest", "n_words").agg(
        F.count_if(~real).alias("copies"),
        F.array_sort(F.collect_set(F.when(real, F.struct("start", "length")))).alias("spans"),
        F.collect_set(F.when(real, F.col("items"))).alias("items"),
    )
    items = F.array_sort(F.transform(F.array_distinct(F.flatten("items")), lambda x: x.cast("string")))
    per = per.select("__key", "__digest", "n_words", "spans", items.alias("items"), F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("one"))
    return per.select(
        F.col("__key").alias(key), F.col("__digest"), F.col("n_words").cast("bigint").alias("n_words"), covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"), "items", (F.size("spans") > 0).alias("contaminated"), "spans",
    )


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words inside (start, stop) spans and the separators before them."""
    pieces = F.regexp_extract_all(text, F.lit(f"{_SEPARATOR}*{_ANY_WORD}+"), F.lit(0))
    tail = F.regexp_extract(text, f"{_SEPARATOR}*$", 0)
    kept = F.filter(pieces, lambda p, i: ~F.exists(spans, lambda s: (i + 1 >= s["start"]) & (i + 1 < s["stop"])))
    return F.concat(F.array_join(kept, ""), tail)


_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``), or without the hit words (``"spans"``)."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is {remove!r}, not 'documents' or 'spans'")
    bad = found(docs, benchmark, key, text, item, item_text, window).filter("contaminated")
    bad = bad.select(F.col(key).alias("__key"), "__digest", merged(F.col("spans")).alias("__spans")).dropDuplicates(["__key", "__digest"])
    tagged = docs.withColumn("__text_digest", F.xxhash64(text))
    match = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__text_digest") == F.col("__digest"))
    if remove == "documents":
        return tagged.join(bad, match, "left_anti").drop("__text_digest")
    joined = tagged.join(bad, match, "left")
    new = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(without_spans(F.col(text), F.col("__spans")))
    return joined.withColumn(text, new).select(*[F.col(f"`{c}`") for c in docs.columns])
