"""Tests of which columns differ between classes. Every statistic comes from one pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.tails import chi2_upper, t_two_sided
from tallymark.session import attach

# Level of significance of all tests; a fixed value of the workload.
SIGNIFICANCE = 0.05


def welch_ttest(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Welch t and degrees of freedom of class 1 against class 0, one row per column."""
    aggregates = []
    for i, c in enumerate(columns):
        for k in (0, 1):
            v = F.when(F.col(label) == k, F.col(c))
            aggregates += [F.count(v).alias(f"n{k}_{i}"), F.avg(v).alias(f"m{k}_{i}"), F.var_samp(v).alias(f"v{k}_{i}")]
    row = df.agg(*aggregates)
    structs = []
    for i, c in enumerate(columns):
        e1, e0 = F.col(f"v1_{i}") / F.col(f"n1_{i}"), F.col(f"v0_{i}") / F.col(f"n0_{i}")
        t = (F.col(f"m1_{i}") - F.col(f"m0_{i}")) / F.sqrt(e1 + e0)
        freedom = (e1 + e0) * (e1 + e0) / (e1 * e1 / (F.col(f"n1_{i}") - 1) + e0 * e0 / (F.col(f"n0_{i}") - 1))
        structs.append(F.struct(
            F.lit(c).alias("column"), F.col(f"m1_{i}").alias("mean1"), F.col(f"m0_{i}").alias("mean0"), t.alias("t"),
            freedom.alias("df"),
        ))
    return row.select(F.inline(F.array(*structs)))


def with_t_pvalue(tests: DataFrame) -> DataFrame:
    tested = tests.withColumn("p", t_two_sided("t", "df"))
    return tested.withColumn("reject", F.col("p") < SIGNIFICANCE)


def chi2_binary(df: DataFrame, columns: list[str], label: str, yates: bool = True) -> DataFrame:
    """Chi-square of 0/1 columns against a 0/1 label, corrected for one degree of freedom unless told otherwise."""
    y = F.col(label)
    aggregates = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("y1")]
    for i, c in enumerate(columns):
        aggregates += [F.sum(F.col(c)).alias(f"x{i}"), F.sum(F.col(c) * y).alias(f"xy{i}")]
    row = df.agg(*aggregates)
    structs = []
    for i, c in enumerate(columns):
        n, y1, x, xy = (F.col(name).cast("double") for name in ("n", "y1", f"x{i}", f"xy{i}"))  # products of counts outgrow bigint
        cells = [(xy, x, y1), (x - xy, x, n - y1), (y1 - xy, n - x, y1), (n - x - y1 + xy, n - x, n - y1)]
        statistic = F.lit(0.0)
        for observed, row_total, column_total in cells:
            expected = row_total * column_total / n
            gap = F.abs(observed - expected)
            if yates:
                gap = gap - F.least(F.lit(0.5), gap)
            statistic = statistic + gap * gap / expected
        structs.append(F.struct(F.lit(c).alias("column"), statistic.alias("chi2"), F.lit(1).alias("dof")))
    return row.select(F.inline(F.array(*structs)))


def chi2_general(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square of two categorical columns of any size, without correction: one row ``chi2, dof, n``.

    Written as sum(O^2 / E) - n, so pairs that never occur need no row. The marginals come from the pair counts.
    """
    pairs = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    with_a = attach(pairs, pairs.groupBy(a).agg(F.sum("o").alias("na")), [a])
    full = attach(with_a, pairs.groupBy(b).agg(F.sum("o").alias("nb")), [b])
    observed = F.col("o").cast("double") / F.col("na") * F.col("o") / F.col("nb")
    summary = full.agg(
        F.sum(observed).alias("s"), F.sum("o").alias("n"), F.count_distinct(a).alias("ka"), F.count_distinct(b).alias("kb")
    )
    chi2: Column = F.col("n") * (F.col("s") - 1.0)
    return summary.select(chi2.alias("chi2"), ((F.col("ka") - 1) * (F.col("kb") - 1)).cast("int").alias("dof"), "n")


def with_chi2_pvalue(tests: DataFrame) -> DataFrame:
    tested = tests.withColumn("p", chi2_upper("chi2", "dof"))
    return tested.withColumn("reject", F.col("p") < SIGNIFICANCE)


def anova_f(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """One-way F per column: between-class over within-class mean square."""
    aggregates = []
    for i, c in enumerate(columns):
        v = F.col(c)
        aggregates += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    classes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(*aggregates)
    structs = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"), F.col(f"v{i}").alias("v"))
        for i, c in enumerate(columns)
    ]
    long = classes.select(F.inline(F.array(*structs))).filter("n > 0")
    # sum n(m - M)^2 with the grand mean M equals the spread of class means weighted by class size.
    sums = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("within"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"),
    )
    between = long.join(sums.select("column", "grand"), "column").groupBy("column").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("between")
    )
    joined = sums.join(between, "column")
    f = (F.col("between") / (F.col("g") - 1)) / (F.col("within") / (F.col("n") - F.col("g")))
    return joined.select("column", f.alias("f"))


def select_k_best(df: DataFrame, columns: list[str], label: str, k: int = 10) -> DataFrame:
    """The k columns with the largest F, ties by name."""
    return anova_f(df, columns, label).orderBy(F.desc("f"), "column").limit(k)
