"""Splits, folds and samples from hash draws: the same rows whatever the partitioning, and no full sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.rng import u
from tallymark.operators.ranking import bucket_count, unit_bucket, with_range_bucket, with_row_number
from tallymark.session import attach

# Range buckets of a split. Only one bucket per class is ranked, so many narrow ones keep that work small at any size.
CUT_BUCKETS = 16_384


def stratified_split(df: DataFrame, key: str, label: str, share: float, salt: str = "split", output: str = "is_test") -> DataFrame:
    """Mark round(n * share) rows of each class as test: the rows with the smallest draws, ties by key.

    Only the draw at the cut is looked up: one count per range bucket finds the bucket of the cut, only the rows of
    that bucket are ranked, and the flag is then a comparison on every row without a shuffle.
    """
    buckets = max(bucket_count(df), CUT_BUCKETS)
    keyed = df.select(F.col(label).alias("__label"), F.col(key).alias("__key"), u(key, salt).alias("__u"))
    keyed = keyed.withColumn("__b", unit_bucket(F.col("__u"), buckets))
    counts = keyed.groupBy("__label", "__b").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("__label").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("__label")
    placed = counts.select(
        "__label", "__b", F.sum("n").over(running).alias("upto"), "n",
        F.floor(F.sum("n").over(whole) * share + 0.5).alias("cut"),
    )
    cut_bucket = placed.filter((F.col("upto") >= F.col("cut")) & (F.col("upto") - F.col("n") < F.col("cut"))).select(
        "__label", F.col("__b").alias("__cut_bucket"), (F.col("cut") - F.col("upto") + F.col("n")).alias("__rank")
    )
    near = attach(keyed, cut_bucket, ["__label"], how="inner").filter(F.col("__b") == F.col("__cut_bucket"))
    order = Window.partitionBy("__label").orderBy("__u", "__key")
    cuts = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") == F.col("__rank")).select(
        F.col("__label").alias(label), F.col("__u").alias("__cut_u"), F.col("__key").alias("__cut_key")
    )
    draw = u(key, salt)
    marked = attach(df, cuts, [label])
    below = (draw < F.col("__cut_u")) | ((draw == F.col("__cut_u")) & (F.col(key) <= F.col("__cut_key")))
    return marked.withColumn(output, F.coalesce(below, F.lit(False))).drop("__cut_u", "__cut_key")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, shuffle: bool = True, salt: str = "fold") -> DataFrame:
    """Add ``fold`` in 0..k-1: rows of a class are dealt in turn, in the order of the draw, or of the key without shuffle."""
    if shuffle:
        drawn = df.withColumn("__u", u(key, salt))
        bucket = unit_bucket(F.col("__u"), bucket_count(df))
        order = [F.col("__u"), F.col(key)]
    else:
        drawn = with_range_bucket(df, key, "__u", bucket_count(df))
        bucket, order = F.col("__u"), [F.col(key)]
    numbered = with_row_number(drawn, "__r", order, bucket, within=[label])
    return numbered.withColumn("fold", ((F.col("__r") - 1) % k).cast("int")).drop("__r", "__u")


def sample_n(df: DataFrame, key: str, n: int, salt: str = "sample") -> DataFrame:
    """Exactly n rows (all if fewer): the smallest draws. Each task keeps n candidates."""
    return df.orderBy(u(key, salt), key).limit(n)


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = n / (number of classes * n of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    total = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__classes"))
    weight: Column = F.col("__n") / (F.col("__classes") * F.col("__nc"))
    return attach(attach(df, counts, [label]), total).withColumn("weight", weight).drop("__nc", "__n", "__classes")
