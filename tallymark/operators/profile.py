"""Counts, summaries, correlations, histograms and densities."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ranking import exact_quantiles
from tallymark.session import attach

#: Rows whose kernel values a task holds at once.
KERNEL_ROWS = 4_096


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``column, n, percent`` per level; the total is added as a constant, so no window spans the levels."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("__total"))
    return attach(counts, total).select(column, "n", (F.col("n") * 100.0 / F.col("__total")).alias("percent"))


def group_value_counts(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.groupBy(group, column).agg(F.count(F.lit(1)).alias("n"))


def _unpivot(row: DataFrame, entries: dict[str, dict[str, Column]], name: str = "column") -> DataFrame:
    """One wide row of aggregates as one row per table column."""
    structs = [
        F.struct(F.lit(key).alias(name), *[value.alias(alias) for alias, value in fields.items()])
        for key, fields in entries.items()
    ]
    return row.select(F.inline(F.array(*structs)))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percent of every column that has nulls, all from one pass."""
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = {c: {"nulls": F.col(c), "percent": F.col(c) * 100.0 / F.col("__n")} for c in df.columns}
    return _unpivot(row, entries).filter("nulls > 0")


def table_info(df: DataFrame) -> DataFrame:
    """Column, type, non-null count and table shape from one pass."""
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in df.columns])
    entries = {
        f.name: {
            "type": F.lit(f.dataType.simpleString()), "non_null": F.col(f.name), "rows": F.col("__n"),
            "columns": F.lit(len(df.columns)),
        }
        for f in df.schema.fields
    }
    return _unpivot(row, entries)


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, mode``: the most frequent value of numeric columns, the smallest on a tie."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    counts = (
        df.select(F.explode(entries).alias("e")).select("e.*").filter("v is not null")
        .groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("column").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))


def central_tendency(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, exact median and mode per column."""
    means = _unpivot(df.agg(*[F.avg(c).alias(c) for c in columns]), {c: {"mean": F.col(c)} for c in columns})
    medians = exact_quantiles(df, columns, {"median": 0.5}).select("column", "median")
    return means.join(medians, "column").join(modes(df, columns), "column")


def range_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    row = df.agg(*[a for c in columns for a in (F.min(c).alias(f"lo_{c}"), F.avg(c).alias(f"av_{c}"), F.max(c).alias(f"hi_{c}"))])
    as_double = lambda name: F.col(name).cast("double")
    entries = {c: {"min": as_double(f"lo_{c}"), "mean": as_double(f"av_{c}"), "max": as_double(f"hi_{c}")} for c in columns}
    return _unpivot(row, entries)


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b, r`` for every ordered pair; a pair uses the rows where both are present. One aggregation pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"r_{a}_{b}") for a, b in pairs])
    structs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r_{a}_{b}").alias("r")) for a, b in pairs]
    structs += [F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"r_{a}_{b}").alias("r")) for a, b in pairs if a != b]
    return row.select(F.inline(F.array(*structs)))


def declared(df: DataFrame, column: str, levels: list) -> None:
    """Raise if ``column`` holds a value other than the declared levels; null is one too."""
    stray = df.filter(F.col(column).isNull() | ~F.col(column).isin(levels)).select(column).first()
    if stray is not None:
        raise ValueError(f"{column} holds {stray[0]!r}, which is not among the declared levels")


def crosstab(df: DataFrame, row: str, column: str, levels: list | None = None) -> DataFrame:
    """Contingency table, zero where a pair never occurs. A level that was not declared is an error; without ``levels`` they come from the data."""
    if levels is None:
        return df.groupBy(row).pivot(column).agg(F.count(F.lit(1))).na.fill(0)
    declared(df, column, levels)
    return df.groupBy(row).pivot(column, levels).agg(F.count(F.lit(1))).na.fill(0)


def _bin(column: str, low: Column, high: Column, bins: int) -> Column:
    position = F.floor((F.col(column) - low) / (high - low) * bins)
    return F.when(high == low, F.lit(0)).otherwise(F.least(position, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """``[by], bin, left, right, n`` with equal-width bins over the whole column; the last bin is closed, empty bins stay.

    Classes share the edges. Dense bins come from the class list, itself one row per class.
    """
    edges = df.agg(F.min(column).cast("double").alias("__lo"), F.max(column).cast("double").alias("__hi"))
    keys = [by] if by else []
    slim = attach(df.select(*keys, column).filter(F.col(column).isNotNull()), edges)
    counts = slim.groupBy(*keys, _bin(column, F.col("__lo"), F.col("__hi"), bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    base = counts.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    dense = attach(base.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")), edges)
    width = (F.col("__hi") - F.col("__lo")) / bins
    return dense.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("__lo") + F.col("bin") * width).alias("left"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("right"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def kde_grid(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density at evenly spaced points: ``point, x, density``.

    Bandwidth is sample deviation times n^(-1/5); the points reach three bandwidths beyond the data. Every task adds up
    its own rows per point, so only ``points`` partial sums per task are shuffled and no value is. A column without two
    different values has no density: the result is empty.
    """
    stats = df.agg(F.count(column).alias("n"), F.stddev_samp(column).alias("sd"), F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if not stats["sd"]:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = float(stats["sd"]) * stats["n"] ** -0.2
    low, step = float(stats["lo"]) - 3 * h, (float(stats["hi"]) - float(stats["lo"]) + 6 * h) / (points - 1)
    at = low + step * np.arange(points)

    def partial(batches):
        sums = np.zeros(points)
        for batch in batches:
            values = batch.column("v").to_numpy(zero_copy_only=False)
            for a in range(0, len(values), KERNEL_ROWS):
                z = (at[:, None] - values[None, a:a + KERNEL_ROWS]) / h
                sums += np.exp(-0.5 * z * z).sum(axis=1)
        yield pa.record_batch([pa.array(np.arange(points), pa.int32()), pa.array(sums)], names=["point", "s"])

    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    sums = values.mapInArrow(partial, "point int, s double").groupBy("point").agg(F.sum("s").alias("s"))
    x = F.lit(low) + F.col("point") * F.lit(step)
    return sums.select("point", x.alias("x"), (F.col("s") / (stats["n"] * h * math.sqrt(2 * math.pi))).alias("density"))


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, interquartile range, whiskers (last datum within 1.5 IQR) and outlier count per group."""
    quartiles = exact_quantiles(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[by]).drop("column", "n")
    joined = attach(df.select(by, column), quartiles, [by]).withColumn("iqr", F.col("q3") - F.col("q1"))
    v = F.col(column)
    inside = v.between(F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr"))
    return joined.groupBy(by).agg(
        *[F.first(c).alias(c) for c in ("q1", "median", "q3", "iqr")],
        F.min(F.when(inside, v)).alias("low_whisker"), F.max(F.when(inside, v)).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def item_score(df: DataFrame, item: str, score: str, how: str = "max") -> DataFrame:
    """Score of an item from the scores of its parts."""
    return df.groupBy(item).agg((F.max(score) if how == "max" else F.avg(score)).alias(score))
