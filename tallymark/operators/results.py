"""Result tables of experiments: summaries, best rows, reshaping, comparison with a baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.profile import declared
from tallymark.session import attach


def plus_minus(mean: Column, spread: Column, digits: int = 3) -> Column:
    """Text such as ``0.842±0.053``."""
    return F.format_string(f"%.{digits}f±%.{digits}f", F.round(mean, digits), F.round(spread, digits))


def parse_plus_minus(text: Column) -> tuple[Column, Column]:
    parts = F.split(text, "±")
    return parts[0].cast("double"), parts[1].cast("double")


def fold_summary(df: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Mean and population deviation over the folds, with the text form; a failed fold is null and left out."""
    stats = df.groupBy(*keys).agg(
        F.avg(metric).alias(f"{metric}_mean"), F.stddev_pop(metric).alias(f"{metric}_std"), F.count(metric).alias("folds")
    )
    return stats.withColumn(f"{metric}_text", plus_minus(F.col(f"{metric}_mean"), F.col(f"{metric}_std")))


def scenario_summary(df: DataFrame, scenario: str, model: str, metric: str) -> DataFrame:
    """Average and best metric per scenario and the best model, the first name on a tie."""
    return df.groupBy(scenario).agg(
        F.avg(metric).alias(f"{metric}_avg"), F.max(metric).alias(f"{metric}_best"),
        F.min_by(model, F.struct(-F.col(metric), F.col(model))).alias("best_model"),
    )


def best_per_group(df: DataFrame, group: list[str], metric: str, key: list[str], highest: bool = True) -> DataFrame:
    """The whole best row of each group, ties by key.

    An aggregate over structs combines on the map side, so a large group is never sorted in one task.
    """
    lead = -F.col(metric) if highest else F.col(metric)
    picked = df.filter(F.col(metric).isNotNull()).groupBy(*group).agg(
        F.min(F.struct(lead.alias("__lead"), *key, *[c for c in df.columns if c not in [*group, *key]])).alias("r")
    )
    return picked.select(*[F.col(c) if c in group else F.col(f"r.{c}").alias(c) for c in df.columns])


def best_and_worst(df: DataFrame, group: list[str], metric: str, key: str) -> DataFrame:
    """Names of the best and the worst row per group."""
    return df.filter(F.col(metric).isNotNull()).groupBy(*group).agg(
        F.min_by(key, F.struct(-F.col(metric), F.col(key))).alias("best"),
        F.min_by(key, F.struct(F.col(metric), F.col(key))).alias("worst"),
    )


def top_rows(df: DataFrame, metric: str, key: list[str], n: int) -> DataFrame:
    """The n highest rows, ties by key; each task keeps only n rows."""
    return df.orderBy(F.desc(metric), *key).limit(n)


def ranked_top(df: DataFrame, metric: str, key: list[str], n: int) -> DataFrame:
    """The n highest rows with their rank; the window sees n rows."""
    window = Window.orderBy(F.desc(metric), *key)
    return top_rows(df, metric, key, n).withColumn("rank", F.row_number().over(window))


def in_label_order(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """Keep rows whose label is listed and sort by the list; adds ``position``."""
    position = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(column))
    return df.withColumn("position", position.cast("int")).filter("position > 0").orderBy("position")


def append(frames: list[DataFrame]) -> DataFrame:
    """Result sets under each other; columns are matched by name and may be missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def melt(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Wide metric columns as ``ids.., metric, score``."""
    return df.unpivot(ids, metrics, "metric", "score")


def pivot_metric(df: DataFrame, row: str, column: str, levels: list[str] | None, metric: str) -> DataFrame:
    """Row by column matrix of one metric; an absent cell is null. A level that was not declared is an error; ``None`` takes them from the data."""
    if levels is None:
        return df.groupBy(row).pivot(column).agg(F.first(metric))
    declared(df, column, levels)
    return df.groupBy(row).pivot(column, levels).agg(F.first(metric))


def full_matrix(df: DataFrame, a: str, b: str, metrics: list[str], levels: list) -> DataFrame:
    """One row for every value of ``a`` and every level of ``b``; absent pairs have null metrics."""
    dimension = df.select(a).distinct().select(a, F.explode(F.array(*[F.lit(v) for v in levels])).alias(b))
    return dimension.join(df.select(a, b, *metrics), [a, b], "left")


def uplift(df: DataFrame, metrics: list[str], baseline: Column) -> DataFrame:
    """Percent change of each metric against the single row where ``baseline`` holds."""
    base = df.filter(baseline).agg(*[F.max(m).alias(f"__b_{m}") for m in metrics])
    joined = attach(df, base)
    gain = {f"{m}_uplift": (F.col(m) - F.col(f"__b_{m}")) / F.col(f"__b_{m}") * 100.0 for m in metrics}
    return joined.withColumns(gain).drop(*[f"__b_{m}" for m in metrics])


def param_grid(spark, axes: dict[str, list]) -> DataFrame:
    """Every combination of the axis values, numbered from 1 in axis order."""
    grid, number = spark.range(1).select(F.lit(0).alias("experiment")), F.col("experiment")
    for name, values in axes.items():
        axis = F.posexplode(F.array(*[F.lit(v) for v in values])).alias("__p", name)
        grid = grid.select("*", axis).withColumn("experiment", number * len(values) + F.col("__p")).drop("__p")
    return grid.withColumn("experiment", F.col("experiment") + 1)


def compare_models(frames: dict[str, DataFrame], metrics: list[str]) -> DataFrame:
    """One row per model with the same metric columns; a metric a model lacks is 0."""
    parts = []
    for name, frame in frames.items():
        have = [F.coalesce(F.col(m), F.lit(0.0)).alias(m) if m in frame.columns else F.lit(0.0).alias(m) for m in metrics]
        parts.append(frame.select(F.lit(name).alias("model"), *have))
    return append(parts)


def metric_ranks(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Rank of every row by each metric, 1 for the highest. Meant for result tables: one row per model."""
    return df.withColumns({f"{m}_rank": F.rank().over(Window.orderBy(F.desc(m))) for m in metrics})


def flatten_config(df: DataFrame, model: str, config: str, common: dict[str, str], own: dict[str, dict[str, str]]) -> DataFrame:
    """Nested configuration to columns: ``common`` for every model, ``own`` only for its model and null elsewhere.

    Both map an output column to a path inside ``config``; several models may share an output column.
    """
    columns = {name: F.col(f"{config}.{path}") for name, path in common.items()}
    names = dict.fromkeys(name for fields in own.values() for name in fields)
    for name in names:
        choices = [F.when(F.col(model) == m, F.col(f"{config}.{fields[name]}")) for m, fields in own.items() if name in fields]
        columns[name] = F.coalesce(*choices)
    return df.withColumns(columns)
