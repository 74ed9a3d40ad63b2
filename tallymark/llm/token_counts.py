"""Token counts with a cache of content digests.

Defined cases: null text counts as empty (0 tokens); repeated rows and copies are encoded once and counted each; an empty
table gives an empty result; columns of the input named like an output are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fresh, text_or_empty
from tallymark.llm.tokens import encoder, version_digest

CACHE = "content binary, tokenizer string, n_tokens bigint"


def cached(spark, path: str, tokenizer: str) -> DataFrame:
    """What the cache holds for a tokenizer version; nothing if there is no cache yet.

    Two runs may have appended the same digest, so equal digests count once.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], CACHE)
    rows = spark.read.schema(CACHE).parquet(path).filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str, text: str = "text", keeps_space: bool = True, limit: int = 1024,
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    Contents are named by their SHA-256. Those without a count for this tokenizer version are encoded, each distinct one
    once, and appended to the Parquet table at ``cache_path``; then every document takes its count from there.
    """
    spark, version = docs.sparkSession, version_digest(tokenizer_path)
    docs = fresh(docs, "n_bytes", "n_tokens", "over_limit")
    content = F.unhex(F.sha2(text_or_empty(text), 256))
    known = cached(spark, cache_path, version)
    missing = docs.select(content.alias("content"), text_or_empty(text).alias("text"))
    missing = missing.groupBy("content").agg(F.any_value("text").alias("text"))  # copies meet in the tasks that read them
    missing = missing.join(known.select("content"), "content", "left_anti")

    def count(batches):
        own = encoder(tokenizer_path, keeps_space)
        for batch in batches:
            sizes = [part for _, _, bounds in own.batches(batch.column("text")) for part in (bounds[1:] - bounds[:-1]).tolist()]
            yield pa.record_batch([batch.column("content"), pa.array(sizes, pa.int64())], names=["content", "n_tokens"])

    new = missing.mapInArrow(count, "content binary, n_tokens bigint")
    new.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    counts = cached(spark, cache_path, version).select(F.col("content").alias("__content"), "n_tokens")
    out = docs.withColumns({"n_bytes": F.octet_length(text_or_empty(text)).cast("bigint"), "__own": content})
    out = out.join(counts, F.col("__own") == F.col("__content"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
