"""Scaling. ``fit_*`` returns one row with ``<column>__shift`` and ``<column>__scale``; ``transform`` applies it to any frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ranking import exact_quantiles, quantile_row
from tallymark.session import attach

# Keeps the divisor of a min-max scale away from zero; a fixed value of the workload.
EPSILON = 1e-8


def _nonzero(scale: Column) -> Column:
    return F.when(scale == 0, F.lit(1.0)).otherwise(scale)


def _evaluated(fitted: DataFrame) -> DataFrame:
    """The single fitted row as a local table, so that applying it again reads no data again."""
    return fitted.sparkSession.createDataFrame([tuple(fitted.first())], fitted.schema)


def fit_standard(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation; a constant column is divided by 1."""
    stats = []
    for c in columns:
        stats += [F.avg(c).alias(f"{c}__shift"), _nonzero(F.stddev_pop(c)).alias(f"{c}__scale")]
    return _evaluated(df.agg(*stats))


def fit_robust(df: DataFrame, columns: list[str]) -> DataFrame:
    """Median and interquartile range from exact, linearly interpolated quantiles."""
    fitted = quantile_row(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    values = {}
    for c in columns:
        values[f"{c}__shift"] = fitted[c]["q50"]
        values[f"{c}__scale"] = (fitted[c]["q75"] - fitted[c]["q25"]) or 1.0
    return df.sparkSession.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` double" for k in values))


def fit_minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum and range plus a small epsilon."""
    stats = []
    for c in columns:
        stats += [F.min(c).cast("double").alias(f"{c}__shift"), (F.max(c) - F.min(c) + F.lit(EPSILON)).alias(f"{c}__scale")]
    return _evaluated(df.agg(*stats))


def transform(df: DataFrame, fitted: DataFrame, columns: list[str]) -> DataFrame:
    """(x - shift) / scale with the fitted numbers as constants of the plan: no join, no shuffle."""
    values = fitted.first()
    return df.withColumns({c: (F.col(c) - F.lit(values[f"{c}__shift"])) / F.lit(values[f"{c}__scale"]) for c in columns})


def _item_stats(df: DataFrame, item: str, aggregates: list[Column]) -> DataFrame:
    # Aggregating and joining back combines on the map side; a window would move every row of a large item to one task.
    return attach(df, df.groupBy(item).agg(*aggregates), [item])


def minmax_within(df: DataFrame, item: str, column: str) -> DataFrame:
    """Per-item min-max; a constant item becomes 0."""
    joined = _item_stats(df, item, [F.min(column).alias("__lo"), F.max(column).alias("__hi")])
    spread = F.col("__hi") - F.col("__lo")
    scaled = F.when(spread == 0, F.lit(0.0)).otherwise((F.col(column) - F.col("__lo")) / spread)
    return joined.withColumn(column, F.when(F.col(column).isNotNull(), scaled)).drop("__lo", "__hi")


def zscore_within(df: DataFrame, item: str, column: str) -> DataFrame:
    """Per-item z-score, then per-item min-max. The extremes of the z-score follow from those of the raw values."""
    joined = _item_stats(df, item, [
        F.avg(column).alias("__mean"), (F.stddev_pop(column) + EPSILON).alias("__sd"),
        F.min(column).alias("__lo"), F.max(column).alias("__hi"),
    ])
    z = lambda v: (v - F.col("__mean")) / F.col("__sd")
    scaled = (z(F.col(column)) - z(F.col("__lo"))) / (z(F.col("__hi")) - z(F.col("__lo")) + EPSILON)
    return joined.withColumn(column, scaled).drop("__mean", "__sd", "__lo", "__hi")


def percentile_clip_within(df: DataFrame, item: str, column: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Per-item rescaling of the range between two exact percentiles, clipped to [0, 1]."""
    cuts = exact_quantiles(df, [column], {"__lo": low, "__hi": high}, by=[item]).select(item, "__lo", "__hi")
    joined = attach(df, cuts, [item])
    scaled = (F.col(column) - F.col("__lo")) / (F.col("__hi") - F.col("__lo") + EPSILON)
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))
    return joined.withColumn(column, F.when(F.col(column).isNotNull(), clipped)).drop("__lo", "__hi")
