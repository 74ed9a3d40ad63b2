"""A corpus from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import decontaminate, minmax, packing, perplexity, secrets
from tallymark.llm.common import table
from tallymark.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside their language's perplexity band."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes with the measures
    at = dict(zip(docs.columns, names))
    kept = perplexity.quality_rules(docs.toDF(*names), at["text"], at["lang"], names).filter("kept")
    return kept.select(*[F.col(own).alias(name) for name, own in at.items()])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minmax.drop_near_duplicates(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked; n_chars is that of the new text."""
    return secrets.redact(docs, reach=None).withColumn("n_chars", F.char_length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality), ("near duplicates", near_dedup), ("decontamination", benchmark_free), ("secret scans", secret_free), ("best-fit packing", packed),
]

#: Token ids and perplexity are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
