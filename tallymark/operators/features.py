"""New columns from old ones: clipping, bins, products, ratios, projections."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.rng import u
from tallymark.functions.vectors import times_matrix
from tallymark.operators.moments import cross_products
from tallymark.operators.ranking import values_at_ranks


def winsorize(df: DataFrame, columns: list[str], low: float = 0.05, high: float = 0.05) -> DataFrame:
    """The lowest floor(low*n) values become the next order statistic, and the same at the top.

    Replacing by rank equals clipping at the two order statistics, so only those are looked up.
    """
    ranks = {
        "lo": (low, lambda n: F.floor(F.lit(low) * n) + 1),
        "hi": (1.0 - high, lambda n: n - F.floor(F.lit(high) * n)),
    }
    cuts = {r["column"]: r for r in values_at_ranks(df, columns, ranks).collect()}
    return df.withColumns({
        c: F.when(
            F.col(c).isNotNull(),
            F.greatest(F.lit(cuts[c]["lo"]), F.least(F.lit(cuts[c]["hi"]), F.col(c).cast("double"))),
        )
        for c in columns
    })


def bin_right_closed(column: Column | str, edges: list[float], fallback: int | None = None) -> Column:
    """Number of the interval (e0, e1], (e1, e2], .. that holds the value; ``fallback`` (or null) outside."""
    column = F.col(column) if isinstance(column, str) else column
    result = F.lit(fallback).cast("int")
    for i in reversed(range(len(edges) - 1)):
        result = F.when((column > edges[i]) & (column <= edges[i + 1]), F.lit(i)).otherwise(result)
    return result


def product(a: str, b: str, divisor: float = 10_000.0) -> Column:
    return F.col(a) * F.col(b) / F.lit(divisor)


def ratio(a: str, b: str, denominator_offset: float = 1.0) -> Column:
    return F.col(a) / (F.col(b) + F.lit(denominator_offset))


def width_of(df: DataFrame, vec: str) -> int:
    return df.select(F.size(vec)).first()[0]


def mean_vector(df: DataFrame, vec: str) -> list[float]:
    """Mean of every coordinate; one row of numbers reaches the driver."""
    return list(df.agg(*[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(width_of(df, vec))]).first())


def covariance_long(df: DataFrame, vec: str) -> DataFrame:
    """Sample covariance of the coordinates as ``i, j, cov``, from cross products that are merged in a tree of tasks."""
    total, n = cross_products(df, vec, np.array(mean_vector(df, vec)))
    rows = [(i, j, float(v) / (n - 1) if n > 1 else None) for (i, j), v in np.ndenumerate(total)]
    return df.sparkSession.createDataFrame(rows, "i int, j int, cov double")


def random_projection(df: DataFrame, vec: str, target: int, output: str = "projected") -> DataFrame:
    """Sparse random projection to ``target`` coordinates; narrower vectors pass unchanged.

    An entry of the hash-defined matrix is +-sqrt(s / target) with probability 1/(2s) each and 0 otherwise,
    s = sqrt(width). Rows meet the matrix in one product for each batch.
    """
    width = width_of(df, vec)
    if width <= target:
        return df.withColumn(output, F.col(vec))
    s = math.sqrt(width)
    cell = df.sparkSession.range(width * target).select(
        F.expr(f"id div {target}").alias("j"), (F.col("id") % target).alias("out")
    )
    draw = u("j", F.concat(F.lit("rp"), F.col("out")))
    sign = F.when(draw < 1 / (2 * s), 1).when(draw < 1 / s, -1).otherwise(0)
    matrix = np.zeros((width, target))
    for e in cell.select("j", "out", sign.alias("sign")).filter("sign != 0").collect():
        matrix[e["j"], e["out"]] = e["sign"] * math.sqrt(s / target)
    return df.withColumn(output, times_matrix(F.col(vec).cast("array<double>"), matrix))
