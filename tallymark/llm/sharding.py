"""Sharding by a two-pass external shuffle.

First records are scattered by seeded hashes into buckets small enough for memory: the shard from the key alone (jump
hashing, so one more shard takes records only into itself), the bucket within the shard from the whole record. Then each
bucket is permuted by a Fisher-Yates shuffle of its places and written. The places follow from the records and the seed alone, not
from the partitioning of the input, so a repeated task deals them again as before.

Defined cases: null keys go to the shard of a fixed hash; null text has size 1; equal records lie in the same bucket, in any
order; an empty table gives an empty result; columns of the input named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import fresh, row_digest, text_or_empty
from tallymark.session import written

SHARDS = 16
SEED = 20_240_601
BUCKET_BYTES = 16 << 20
#: Largest number of records that a bucket's permutation is made for at once.
BUCKET_RECORDS = 1_000_000
#: Buckets whose permutations one task draws.
TASK_BUCKETS = 16


def unit(x: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1, 1 excluded."""
    return F.shiftrightunsigned(x, 11).cast("double") / F.lit(float(1 << 53))


def jump_shard(key: Column, shards: int, seed: int) -> Column:
    """Shard of a key: from shard count n to n + 1 a key stays, or moves to shard n with chance 1 / (n + 1)."""
    moves = [F.when(unit(F.xxhash64(key, F.lit(seed), F.lit(n))) < 1.0 / (n + 1), F.lit(n)) for n in range(shards - 1, 0, -1)]
    return F.coalesce(*moves, F.lit(0)).cast("int")


def assigned(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, bucket_records: int = BUCKET_RECORDS,
) -> DataFrame:
    """``docs`` with size, text_crc32, shard, slot (gapless from 0 in each shard), grown_shard and bucket."""
    names = ("size", "text_crc32", "shard", "slot", "grown_shard", "bucket")
    docs = fresh(docs, *names)
    size = (F.octet_length(text_or_empty(text)) + 1).cast("bigint")
    total = docs.agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).first()
    per_shard = max(1, -(-(total["bytes"] or 0) // (shards * bucket_bytes)), -(-total["n"] // (shards * bucket_records)))
    shard = jump_shard(F.col(key), shards, seed)
    df = docs.withColumn("__digest", row_digest(docs)).withColumn("shard", shard)
    df = df.withColumn("bucket", (F.col("shard") * per_shard + F.pmod(F.xxhash64("__digest", F.lit(seed + 1)), F.lit(per_shard))).cast("bigint"))

    # Permutation of each bucket's places, and how many records lie before it in its shard.
    counts = written(df.groupBy("shard", "bucket").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    places = F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))
    order = counts.select(F.col("bucket").alias("__bucket"), F.coalesce(before, F.lit(0)).alias("__before"), "n")
    # The draws of a task follow from its number and the order of its rows, so both are made to depend on the buckets alone.
    buckets = shards * per_shard
    order = order.repartition(-(-buckets // TASK_BUCKETS), "__bucket").sortWithinPartitions("__bucket")
    order = order.select("__bucket", "__before", shuffled(places, seed).alias("__places"))

    number = F.row_number().over(Window.partitionBy("bucket").orderBy("__digest", key))
    df = df.withColumns({"size": size, "text_crc32": F.crc32(text_or_empty(text)), "grown_shard": jump_shard(F.col(key), shards + 1, seed)})
    df = df.withColumn("__number", number).join(order, F.col("bucket") == F.col("__bucket"))
    slot = F.col("__before") + F.element_at("__places", F.col("__number"))
    return df.withColumn("slot", slot.cast("bigint")).select(*[F.col(f"`{c}`") for c in docs.columns], *names)


def shuffled(places: Column, seed: int) -> Column:
    """Fisher-Yates shuffle of an array."""
    return F.shuffle(places, F.lit(seed))


def write_shards(assigned_docs: DataFrame, path: str) -> None:
    """Writes a folder for each shard, its files in the order of slots, a bucket never split between files."""
    assigned_docs.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
