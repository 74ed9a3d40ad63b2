"""Draws worked out in tasks against those of Spark, and cluster sums from matrix products against plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.functions.rng import draws, u
from tallymark.operators import cluster


def test_draws_are_those_of_spark(spark):
    keys = [0, 7, 10, 99, -1, -1234, 123456789012, 2**63 - 1, -(2**63), None]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, key bigint")
    salts = ["start0_0", "fold", "start12_9"]
    want = [[r[s] for r in df.select("i", *[u("key", s).alias(s) for s in salts]).orderBy("i").collect()] for s in salts]
    numbers = np.ma.masked_array([k or 0 for k in keys], [k is None for k in keys])
    assert draws(numbers, salts).tolist() == want
    many = np.arange(95_000, 165_600)
    assert draws(many, ["a"])[0, [0, 4_999, 5_000, 70_599]].tolist() == [draws(many[[i]], ["a"])[0, 0] for i in (0, 4_999, 5_000, 70_599)]


def test_starts_do_not_depend_on_the_kind_of_the_key(spark):
    """Whole numbers are drawn in the tasks, other keys by Spark; few of the rows are measured, the centres are the same."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)).tolist() + [[40.0, 0.0, 0.0]] * 3
    numbers = spark.createDataFrame([(i if i % 50 else None, v) for i, v in enumerate(x)], "key int, vec array<double>").repartition(5)
    texts = numbers.withColumn("key", F.col("key").cast("string"))
    some = cluster.starting_centres(numbers, 4, 6)
    assert some.shape == (6, 4, 3) and (some == cluster.starting_centres(texts, 4, 6)).all()
    rows = numbers.collect()
    points, keys = np.array([r["vec"] for r in rows]), np.ma.masked_array([r["key"] or 0 for r in rows], [r["key"] is None for r in rows])
    for s in range(6):
        for j in range(1, 4):
            near = cluster.squares_to(points, some[s, :j]).min(axis=1)
            time = -np.log(draws(keys, [f"start{s}_{j}"])[0]) / np.where(near > 0, near, 1e-300)
            assert near[time.argmin()] > 0 and (points[time == time.min()] == some[s, j]).all(axis=1).any()


@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e20), (-3.0, 1e-9)])
def test_sums_from_products_are_the_plain_ones(shift, scale):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(3_000, 4)), np.zeros((5, 4)), rng.integers(0, 3, (2_000, 4))]) * scale + shift
    starts = [x[rng.choice(len(x), k)] for k in (1, 2, 2, 5, 5, 5, 9)]
    starts += [np.vstack([x[:2], x[:2]]), (rng.integers(0, 3, (6, 4)) + np.array([0.5, 0, 0, 0])) * scale + shift]  # equal centres, and ties
    flat, bounds = np.vstack(starts), np.cumsum([0] + [len(c) for c in starts])
    want, have = np.zeros((len(flat), 5)), np.zeros((len(flat), 5))
    cluster.add_clusters(x, flat, bounds, want, np.zeros(len(starts)))
    cluster.add_sums(x, flat, bounds, have)
    assert (have[:, -1] == want[:, -1]).all() and have == pytest.approx(want, rel=1e-12, abs=1e-9 * scale)
    odd = x[:50].copy()
    odd[3, 1] = np.nan
    want[:], have[:] = 0, 0
    cluster.add_clusters(odd, flat, bounds, want, np.zeros(len(starts)))
    cluster.add_sums(odd, flat, bounds, have)
    assert have == pytest.approx(want, nan_ok=True)


def test_a_pass_reads_packed_vectors(spark, monkeypatch):
    monkeypatch.setattr(cluster, "PACKED_BYTES", 7 * 24)
    df = spark.createDataFrame([(i, [float(i), 1.0, -i / 3]) for i in range(100)], "key int, vec array<double>").repartition(3)
    blobs = cluster.packed(df, 3)
    x = np.vstack(list(cluster.unpacked(blobs.toArrow().column("x").combine_chunks(), 3)))
    assert blobs.count() >= 15 and sorted(x[:, 0]) == list(range(100)) and (x[:, 2] == -x[:, 0] / 3).all()
    found = cluster.kmeans(df, [1, 2], restarts=2)
    assert found[1].inertia == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
