"""The large-data paths give the results of the plain ones: many blocks, many buckets, tiles, sketches, partitions."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from queries import QUERIES
from tallymark.operators import evaluate, grid, neighbours, ranking
from tallymark.session import attach, few_rows, shared_dir


@pytest.fixture(scope="module")
def clouds(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(230, 4)).round(1)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return points, spark.createDataFrame(rows, "id bigint, vec array<double>")


@pytest.mark.parametrize("p, block_rows, pivots", [(1, 17, 0), (2, 17, 0), (3, 1000, 0), (2, 1000, 0), (1, 1000, 9), (2, 17, 9), (2, 1000, 400)])
def test_neighbours_against_brute_force(clouds, p, block_rows, pivots):
    points, df = clouds
    found = neighbours.knn_join(df, df, 4, "id", "id", p=p, exclude_self=True, pivots=pivots, block_rows=block_rows)
    got = {(r["left_key"], r["rank"]): r["right_key"] for r in found.collect()}
    for i, point in enumerate(points):
        dist = (np.abs(points - point) ** p).sum(axis=1) ** (1 / p)
        dist[i] = np.inf
        order = sorted(range(len(points)), key=lambda j: (round(dist[j], 12), j))
        # Rounded inputs give many exact ties, which go to the smaller key.
        assert [round(dist[got[i, r]], 9) for r in range(1, 5)] == [round(dist[j], 9) for j in order[:4]]
    assert len(got) == 4 * len(points)


def test_row_numbers_equal_the_plain_window(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"), (F.hash("id") % 1000).cast("double").alias("x"))
    ranged = ranking.with_range_bucket(df, "id", "b", 40)
    got = ranking.with_row_number(ranged, "r", [F.col("id")], F.col("b"), within=["g"])
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    assert got.join(plain.select("id", "p"), "id").filter("r != p").count() == 0


def test_bucketed_roc_equals_the_small_one(spark, monkeypatch):
    df = spark.range(4000).select((F.pmod(F.hash("id"), F.lit(1500)) / 1500).alias("s"), (F.pmod(F.hash("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("y"))
    small = evaluate.roc_points(df, "s", "y").select("threshold", "tp", "fp").orderBy("threshold").collect()
    monkeypatch.setattr("tallymark.session.SMALL_ROWS", 10)
    assert evaluate.roc_points(df, "s", "y").select("threshold", "tp", "fp").orderBy("threshold").collect() == small


def test_sketched_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SKETCH_ROWS", 200)
    df = spark.range(20_000).select((F.pmod(F.hash("id"), F.lit(7919)) / 10).alias("x"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("g"))
    rows = df.collect()
    for row in ranking.exact_quantiles(df, ["x"], {"lo": 0.02, "mid": 0.5, "hi": 0.98}, by=["g"]).collect():
        mine = [r["x"] for r in rows if r["g"] == row["g"]]
        for label, p in (("lo", 0.02), ("mid", 0.5), ("hi", 0.98)):
            assert abs(row[label] - np.quantile(mine, p)) < 1e-9


def test_a_hot_value_keeps_quantiles_exact(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SKETCH_ROWS", 100)
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") % 1000).cast("double")).alias("x"))
    row = ranking.exact_quantiles(df, ["x"], {"q": 0.25}).first()
    assert row["q"] == np.quantile([r["x"] for r in df.collect()], 0.25)


@pytest.mark.parametrize("tile", [5, 16])
def test_tiles_do_not_show(spark, monkeypatch, tile):
    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, size=(23, 31))
    rows = [("g", x, y, float(image[y, x])) for y in range(23) for x in range(31)]
    df = spark.createDataFrame(rows, "grid string, x int, y int, v double")
    whole = {(r["x"], r["y"]): r["v"] for r in grid.gaussian_blur(df).collect()}
    median = {(r["x"], r["y"]): r["v"] for r in grid.median_filter(df).collect()}
    monkeypatch.setattr(grid, "TILE", tile)
    assert {(r["x"], r["y"]): r["v"] for r in grid.gaussian_blur(df).collect()} == whole
    assert {(r["x"], r["y"]): r["v"] for r in grid.median_filter(df).collect()} == median
    padded = np.pad(image.astype(float), 2, mode="reflect")
    expected = grid.to_level(grid.correlate(padded, grid.GAUSSIAN_5))
    assert all(whole[x, y] == expected[y, x] for y in range(23) for x in range(31))


def test_attach_without_broadcast_gives_the_same_rows(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "c")], "id bigint, k string")
    lookup = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    expected = [(1, 1), (2, 2), (3, 3), (4, None)]
    assert [(r["id"], r["v"]) for r in attach(df, lookup, ["k"]).orderBy("id").collect()] == expected
    monkeypatch.setattr("tallymark.session.SMALL_ROWS", 1)
    joined = attach(df, lookup, ["k"])
    assert [(r["id"], r["v"]) for r in joined.orderBy("id").collect()] == expected


def test_long_values_are_never_small(spark):
    assert few_rows(spark.createDataFrame([("x" * 5000,)], "t string")) is None
    assert few_rows(spark.createDataFrame([(list(range(2000)),)], "t array<int>")) is None
    assert few_rows(spark.createDataFrame([("x" * 50, [1, 2])], "t string, a array<int>")) == [("x" * 50, [1, 2])]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", ["split_stratified", "fold_stratified", "smote", "noise_thirds", "scale_percentile_clip", "coreset_greedy"])
def test_partitioning_does_not_change_results(name, spark, data):
    wide = sorted(map(str, QUERIES[name](spark, data).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert sorted(map(str, QUERIES[name](spark, data).collect())) == wide
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
