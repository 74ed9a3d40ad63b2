"""Trees grown from histograms against Spark ML and against hand counts; densities and quantiles in odd cases."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallymark.functions.rng import u
from tallymark.operators import folded, profile, ranking, trees


@pytest.fixture(scope="module")
def levels(spark):
    """Features with 16 whole levels, so that equal-width bins and midpoint thresholds part the rows alike."""
    rows = spark.range(2000).select(F.col("id").alias("key"), F.floor(u("id", "a") * 16).cast("double").alias("a"), F.floor(u("id", "b") * 16).cast("double").alias("b"))
    chance = F.when(F.col("a") > 9, 0.8).otherwise(0.2) + F.when(F.col("b") < 4, 0.15).otherwise(0.0)
    return rows.withColumn("label", (u("key", "y") < chance).cast("int")).cache()


@pytest.mark.parametrize("criterion", ["entropy", "gini"])
def test_same_splits_as_spark_ml(levels, criterion):
    tree = trees.grow(levels, ["a", "b"], depth=2, bins=16, criterion=criterion)
    frame = levels.withColumn("features", array_to_vector(F.array("a", "b")))
    model = DecisionTreeClassifier(impurity=criterion, maxDepth=2, maxBins=16).fit(frame)
    named = {s[0]: s for s in tree.splits}
    edges = tree.edges
    own = trees.predict(levels, tree).select("key", "score")
    # Spark ML prunes leaves that predict the same class, so classes are compared and not shares.
    theirs = model.transform(frame).select("key", "prediction")
    assert own.join(theirs, "key").filter((F.col("score") > 0.5).cast("double") != F.col("prediction")).count() == 0
    root = model._call_java("rootNode").split()
    assert ["a", "b"][root.featureIndex()] == named[1][1]
    low, high = edges[named[1][1]]
    assert math.ceil(root.threshold()) == math.ceil(low + (named[1][2] + 1) * (high - low) / 16 - 1e-9)


def test_nodes_add_up_and_rows_reach_them(levels):
    tree = trees.grow(levels, ["a", "b"], depth=4, bins=8, min_rows=20)
    nodes = {r["node"]: r for r in tree.nodes.collect()}
    for node, r in nodes.items():
        if r["feature"] is not None:
            assert r["n"] == nodes[2 * node]["n"] + nodes[2 * node + 1]["n"] and min(nodes[2 * node]["n"], nodes[2 * node + 1]["n"]) >= 20
    leaves = {r["node"]: r["count"] for r in trees.predict(levels, tree).groupBy("node").count().collect()}
    assert leaves == {n: r["n"] for n, r in nodes.items() if r["feature"] is None}


def test_trees_of_odd_tables(spark):
    kind = "key int, label int, x double"
    empty = trees.grow(spark.createDataFrame([], kind), ["x"])
    assert [(r["node"], r["n"]) for r in empty.nodes.collect()] == [(1, 0)]
    one = trees.grow(spark.createDataFrame([(1, 1, 2.0), (2, 1, 3.0)], kind), ["x"])
    assert one.splits == [] and one.nodes.first()["positives"] == 2
    mixed = spark.createDataFrame([(1, 0, None), (2, 0, 1.0), (3, 1, 9.0), (4, 1, 9.0), (5, None, 5.0), (None, 1, 9.0)], kind)
    tree = trees.grow(mixed, ["x"], bins=4)
    assert [(s[0], s[1], s[2]) for s in tree.splits] == [(1, "x", 0)]
    assert sorted((r["key"] or 0, r["node"], r["score"]) for r in trees.predict(mixed, tree).collect()) == [
        (0, 3, 1.0), (1, 2, 0.0), (2, 2, 0.0), (3, 3, 1.0), (4, 3, 1.0), (5, 3, 1.0)]
    with pytest.raises(ValueError):
        trees.grow(mixed, ["x"], depth=trees.MAX_DEPTH + 1)


def test_newton_finds_what_spark_ml_finds(levels):
    frame = levels.select("key", "label", F.array(F.col("a") / 8 - 1, F.col("b") / 8 - 1).alias("vec"), F.lit(0).alias("fold"))
    weights = folded.newton(frame, [(None, 0.01, 0.0, False)])[0]
    model = LogisticRegression(regParam=0.01, standardization=False, tol=1e-12, maxIter=500).fit(frame.withColumn("features", array_to_vector("vec")))
    np.testing.assert_allclose(weights, [*model.coefficients, model.intercept], atol=1e-6)


def test_density_of_odd_columns(spark):
    for rows in ([], [(None,)], [(3.0,)], [(3.0,), (3.0,)]):
        assert profile.kde_grid(spark.createDataFrame(rows, "x double"), "x").count() == 0
    values = [1.0, 2.0, 2.0, 7.0]
    got = profile.kde_grid(spark.createDataFrame([(v,) for v in [*values, None]], "x double"), "x", 5).orderBy("point").toPandas()
    h = np.std(values, ddof=1) * 4**-0.2
    want = [np.exp(-0.5 * ((x - np.array(values)) / h) ** 2).sum() / (4 * h * math.sqrt(2 * math.pi)) for x in got.x]
    np.testing.assert_allclose(got.density, want)


def test_quantiles_with_infinite_values_and_large_groups(spark):
    n = 30_000
    df = spark.range(n).select((F.col("id") % 2).alias("g"), F.when(F.col("id") < 2, F.lit(float("-inf"))).otherwise(u("id", "q")).alias("x"))
    got = {r["g"]: r["median"] for r in ranking.exact_quantiles(df, ["x"], {"median": 0.5}, ["g"]).collect()}
    own = df.toPandas()
    for g, values in own.groupby("g").x:
        assert got[g] == pytest.approx(np.sort(values)[n // 4 - 1 : n // 4 + 1].mean(), abs=1e-15)
