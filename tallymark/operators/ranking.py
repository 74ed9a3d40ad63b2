"""Row numbers, running totals and exact order statistics that never sort a whole group in one task.

A window without a selective partition key puts a whole group into one task. The operators here first cut the order
into range buckets, total each bucket, and only then rank inside the buckets; the bucket totals give the offset. The
results equal those of the plain window, whatever the number of buckets.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import attach, settled


def bucket_count(df: DataFrame) -> int:
    """Four range buckets per shuffle partition keep tasks even after hashing the buckets."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def unit_bucket(draw: Column, buckets: int) -> Column:
    """Range bucket of a value in [0, 1)."""
    return F.floor(draw * buckets).cast("int")


def with_range_bucket(df: DataFrame, column: str, name: str, buckets: int) -> DataFrame:
    """Add a bucket number that never decreases with ``column``; cuts are approximate quantiles, so buckets are even."""
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = df.select(F.col(column).cast("double").alias("v")).approxQuantile("v", probabilities, 1.0 / (4 * buckets))
    splits = [float("-inf"), *sorted(c for c in set(cuts) if math.isfinite(c)), float("inf")]
    prepared = df.withColumn("__v", F.col(column).cast("double"))
    if len(splits) == 2:
        # No rows to cut. Written so that it is not folded to a constant, which would make later joins lose their key.
        return prepared.withColumn(name, F.pmod(F.hash("__v"), F.lit(1))).drop("__v")
    cutter = Bucketizer(splits=splits, inputCol="__v", outputCol="__b", handleInvalid="keep")
    return cutter.transform(prepared).withColumn(name, F.col("__b").cast("int")).drop("__v", "__b")


def _offsets(totals: DataFrame, within: list[str], sums: list[str]) -> DataFrame:
    """Total of all earlier buckets; one row per bucket, so this window is bounded by the bucket count per group."""
    keys = [F.col(f"__k.{c}") for c in within] or [F.lit(0)]
    before = Window.partitionBy(*keys).orderBy("__k.__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__k", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__off_{c}") for c in sums])


def with_row_number(df: DataFrame, name: str, order: list, bucket: Column, within: list[str] | None = None) -> DataFrame:
    """Exact ``row_number`` over ``order`` inside ``within``; ``bucket`` must not decrease along ``order``.

    Group and bucket form one key, never null, that the counts, the window and the join share: the rows are shuffled
    once.
    """
    within = list(within or [])
    keyed = df.withColumn("__k", F.struct(*within, bucket.alias("__bucket")))
    totals = keyed.groupBy("__k").agg(F.count(F.lit(1)).alias("n"))
    local = F.row_number().over(Window.partitionBy("__k").orderBy(*order))
    joined = keyed.withColumn("__local", local).join(_offsets(totals, within, ["n"]), "__k")
    return joined.withColumn(name, F.col("__local") + F.col("__off_n")).drop("__k", "__local", "__off_n")


def with_running_totals(
    df: DataFrame, order: str, sums: dict[str, str], within: list[str] | None = None, descending: bool = False,
    small: bool = False,
) -> DataFrame:
    """Running totals ``new name -> column`` along distinct values of ``order``.

    Each value of ``order`` must occur once per group: group by the value first, which also collapses ties. A table
    proven ``small`` needs no buckets.
    """
    within = list(within or [])
    ordering = F.col(order).desc() if descending else F.col(order).asc()
    if small:
        plain = Window.partitionBy(*(within or [F.lit(0)])).orderBy(ordering).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.sum(c).over(plain) for n, c in sums.items()})
    ranged = with_range_bucket(df, order, "__bucket", bucket_count(df))
    number = F.col("__bucket") * (-1 if descending else 1)
    keyed = ranged.withColumn("__k", F.struct(*within, number.alias("__bucket"))).drop("__bucket")
    totals = keyed.groupBy("__k").agg(*[F.sum(c).alias(c) for c in sums.values()])
    running = Window.partitionBy("__k").orderBy(ordering).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumns({f"__run_{n}": F.sum(c).over(running) for n, c in sums.items()})
    joined = local.join(_offsets(totals, within, list(sums.values())), "__k")
    out = joined.withColumns({n: F.col(f"__run_{n}") + F.col(f"__off_{c}") for n, c in sums.items()})
    return out.drop("__k", *[f"__run_{n}" for n in sums], *[f"__off_{c}" for c in sums.values()])


# Relative rank error asked of the quantile sketch; groups up to this many rows are ranked whole.
SKETCH_ROWS = 10_000


def values_at_ranks(df: DataFrame, columns: list[str], ranks: dict, by: list[str] | None = None) -> DataFrame:
    """Exact values at given 1-based ranks of each column, nulls left out.

    ``ranks`` maps a label to ``(share, rank)``: ``rank`` is a function of the non-null count column, ``share`` the
    fraction of rows it sits at. Result: ``by.., column, n`` and one column per label.

    One mergeable quantile sketch per column brackets all ranks, one pass counts the rows below each bracket, and only
    the few values inside a bracket are ranked, in range buckets if they are many. Sketch bounds are proven by the counts: a miss raises, it never returns
    a wrong value. Groups of at most ``SKETCH_ROWS`` rows have a single bracket, the whole group.
    """
    by = list(by or [])
    margin = 4.0 / SKETCH_ROWS
    shares = sorted({share for share, _ in ranks.values()})
    ends = [p for share in shares for p in (max(share - margin, 0.0), min(share + margin, 1.0))]
    stats = []
    for c in columns:
        v = F.col(c).cast("double")
        stats += [
            F.count(v).alias(f"__n_{c}"), F.min(v).alias(f"__min_{c}"), F.max(v).alias(f"__max_{c}"),
            F.percentile_approx(v, ends, F.lit(SKETCH_ROWS)).alias(f"__cuts_{c}"),
        ]
    sketch = df.groupBy(*by).agg(*stats)
    slim = attach(df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]), sketch, by, how="inner")

    def entry(c: str, i: int) -> Column:
        v, few = F.col(c), F.col(f"__n_{c}") <= SKETCH_ROWS
        low = F.col(f"__min_{c}") if shares[i] <= margin else F.when(few, F.col(f"__min_{c}")).otherwise(F.col(f"__cuts_{c}")[2 * i])
        high = F.col(f"__max_{c}") if shares[i] >= 1.0 - margin else F.when(few, F.col(f"__max_{c}")).otherwise(F.col(f"__cuts_{c}")[2 * i + 1])
        position = F.when(v < low, F.lit(0)).when(v <= high, F.lit(1))
        if i > 0:
            position = F.when(~few, position)
        return F.struct(
            F.lit(c).alias("column"), F.lit(i).alias("bracket"), F.col(f"__n_{c}").alias("n"), position.alias("position"),
            F.when(position == 1, v).alias("value"),
        )

    # Rows below a bracket share one key per column and bracket, so map-side combine reduces them to single counts.
    entries = F.array(*[entry(c, i) for c in columns for i in range(len(shares))])
    marked = slim.select(*by, F.inline(F.filter(entries, lambda e: e["position"].isNotNull())))
    counted = marked.groupBy(*by, "column", "bracket", "n", "position", "value").agg(F.count(F.lit(1)).alias("rows"))
    counted, few = settled(counted)
    # What is below a bracket comes first as one row: the bracket holds no lower value, not even an infinite one.
    ordered = counted.withColumn("value", F.coalesce("value", F.lit(float("-inf"))))
    ranked = with_running_totals(ordered, "value", {"upto": "rows"}, within=[*by, "column", "bracket", "n"], small=few)

    def at(label: str) -> Column:
        share, rank = ranks[label]
        bracket = F.when(F.col("n") <= SKETCH_ROWS, F.lit(0)).otherwise(F.lit(shares.index(share)))
        hit = (F.col("bracket") == bracket) & (F.col("upto") >= rank(F.col("n"))) & (F.col("upto") - F.col("rows") < rank(F.col("n")))
        return F.max(F.when(hit & (F.col("position") == 1), F.col("value")))

    found = ranked.groupBy(*by, "column", "n").agg(*[at(label).alias(label) for label in ranks])
    missed = F.raise_error(F.lit("quantile sketch missed the rank")).cast("double")
    return found.select(*by, "column", "n", *[
        F.when(F.col(label).isNull() & rank(F.col("n")).between(1, F.col("n")), missed).otherwise(F.col(label)).alias(label)
        for label, (_, rank) in ranks.items()
    ])


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Linearly interpolated exact quantiles, one row per group and column, one output column per label."""
    by = list(by or [])
    ranks = {}
    for label, p in probabilities.items():
        ranks[f"{label}__a"] = (p, lambda n, p=p: F.floor(F.lit(p) * (n - 1)) + 1)
        ranks[f"{label}__b"] = (p, lambda n, p=p: F.ceil(F.lit(p) * (n - 1)) + 1)
    found = values_at_ranks(df, columns, ranks, by)

    def interpolated(label: str, p: float) -> Column:
        position = F.lit(p) * (F.col("n") - 1)
        low, high = F.col(f"{label}__a"), F.col(f"{label}__b")
        return (low + (high - low) * (position - F.floor(position))).alias(label)

    return found.select(*by, "column", "n", *[interpolated(label, p) for label, p in probabilities.items()])


def quantile_row(df: DataFrame, columns: list[str], probabilities: dict[str, float]) -> dict[str, dict[str, float]]:
    """Exact quantiles of whole columns as Python numbers: one row per column reaches the driver."""
    return {r["column"]: {k: r[k] for k in probabilities} for r in exact_quantiles(df, columns, probabilities).collect()}
