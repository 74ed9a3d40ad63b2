"""Passes that keep every slot busy and work that grows with the input, not faster."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallymark.llm.common import SLICE_BYTES
from tallymark.operators import cluster, models, neighbours, search


def test_kmeans_passes_use_all_slots(spark, monkeypatch):
    seen = []
    lloyd = cluster.lloyd
    monkeypatch.setattr(cluster, "lloyd", lambda rows, *rest: (seen.append(rows.rdd.getNumPartitions()), lloyd(rows, *rest))[1])
    frame = spark.range(400).select(F.col("id").alias("key"), F.array(F.col("id") % 7, F.col("id") % 11).cast("array<double>").alias("vec")).coalesce(1)
    cluster.kmeans(frame, [2], restarts=2)
    assert seen[0] >= spark.sparkContext.defaultParallelism


def test_cluster_sums_follow_from_first_nearest_centres():
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((3_000, 3)), 1)  # many equal distances
    starts = [x[rng.integers(0, len(x), k)] for k in (1, 2, 5, 9, 64, 30)]
    for odd in (False, True):
        if odd:
            x = x.copy()
            x[7, 1] = np.nan
        flat, bounds = np.vstack(starts), np.cumsum([0] + [len(c) for c in starts])
        total, inertia = np.zeros((len(flat), 4)), np.zeros(len(starts))
        with np.errstate(invalid="ignore"):
            cluster.add_clusters(x, flat, bounds, total, inertia)
        for i, centres in enumerate(starts):
            squares = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
            own = squares.argmin(axis=1)
            want = np.array([[*x[own == c].sum(axis=0), (own == c).sum()] for c in range(len(centres))])
            np.testing.assert_allclose(total[bounds[i]:bounds[i + 1]], want, atol=1e-9)
            np.testing.assert_allclose(inertia[i], squares.min(axis=1).sum())


def test_encoder_holds_slices_of_bounded_size():
    import public_tokenizers

    from tallymark.llm.tokens import Encoder

    column = pa.array(["some words and 17 marks. " * 400] * 400)
    sizes = [len(texts.data) for texts, _, _ in Encoder(public_tokenizers.path("word_bpe_49k.json"), False).batches(column)]
    assert sum(sizes) == 4_000_000 and max(sizes) <= SLICE_BYTES


def test_trials_are_counted_not_stored(spark, monkeypatch):
    frame = spark.range(300).select(
        F.col("id").alias("key"), (F.col("id") % 3 == 0).cast("int").alias("label"), F.array((F.col("id") % 3).cast("double"), (F.col("id") % 13).cast("double")).alias("vec")
    )
    candidates = {"a": ("bayes", {}), "b": ("logistic", {"C": 1.0}), "c": ("tree", {"max_depth": 2})}
    rows = search.cross_validate(frame, candidates, 3).groupBy("model").agg(F.avg("f1").alias("f1")).collect()
    want = {r["model"]: r["f1"] for r in rows}

    def refuse(*_):
        raise AssertionError("predictions were stored")

    monkeypatch.setattr(search, "scratch_path", refuse)
    monkeypatch.setattr(search.evaluate, "roc_auc", refuse)
    assert {r["model"]: r["f1_mean"] for r in search.mean_f1(frame, candidates, 3).collect()} == want


def plain(a, b, place, k, p):
    dist = (np.abs(a[:, None, :] - b[None]) ** p).sum(axis=2) ** (1.0 / p)
    return [np.lexsort((place, row))[:k].tolist() for row in dist], dist


def test_nearest_pairs_match_all_distances(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(neighbours, "LEAF_PAIRS", 1_000)
    for width, p, digits in ((2, 2, 1), (3, 1, 0), (5, 3, 2), (2, 1.5, 3), (40, 1, 2), (64, 3, 3), (4, 2, 9)):
        a, b = np.round(rng.standard_normal((150, width)), digits), np.round(rng.standard_normal((700, width)), digits)
        b[300:600] = b[:300]
        if width == 4:
            a, b = a * 1e-6 + 1e6, b * 1e-6 + 1e6  # far from the origin
        place = rng.permutation(len(b))
        row, col, dist = neighbours.nearest_pairs(a, b, place, 5, p)
        _, every = plain(a, b, place, 5, p)
        for i in range(len(a)):
            own = neighbours.pair_distances(a, b, np.full(len(b), i), np.arange(len(b)), p)
            np.testing.assert_array_equal(col[row == i], np.lexsort((place, own))[:5])
        np.testing.assert_allclose(dist, every[row, col], rtol=1e-6)


def test_leaves_are_compared_only_within_reach(monkeypatch):
    seen = []
    every = neighbours._nearest_of_all
    monkeypatch.setattr(neighbours, "_nearest_of_all", lambda a, b, *rest: (seen.append(len(a) * len(b)), every(a, b, *rest))[1])
    rng = np.random.default_rng(4)
    a, b = rng.uniform(size=(4_000, 2)), rng.uniform(size=(8_000, 2))
    neighbours.nearest_pairs(a, b, np.arange(len(b)), 5, 2)
    assert sum(seen) < 0.2 * len(a) * len(b)


def test_units_of_large_joins_have_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SPREAD_PAIRS", 1_000)
    frame = spark.range(300).select(F.col("id").alias("key"), F.array((F.col("id") % 17).cast("double"), (F.col("id") % 5).cast("double")).alias("vec"))
    pairs = neighbours.knn_join(frame, frame, 3, "key", "key", pivots=0, block_rows=30)
    plan = pairs._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert pairs.count() == 900


def test_full_buckets_are_compared_by_matrix(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BUCKET_PAIRS", 50)
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "key long, vec array<double>")
    left = frame.filter("key % 3 = 0")
    got = {(r["left_key"], r["rank"]): r["right_key"] for r in neighbours.knn_join_lsh(left, frame, 4, "key", "key", recall=0.999).collect()}
    want = {(r["left_key"], r["rank"]): r["right_key"] for r in neighbours.knn_join(left, frame, 4, "key", "key", pivots=0).collect()}
    assert len(got) == len(want) and sum(got[i] == want[i] for i in want) > 0.95 * len(want)


def test_fits_of_many_rows_have_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(models, "MOST_TASK_ROWS", 50)
    rows = spark.range(1_000).coalesce(1)
    assert models.compact(rows).rdd.getNumPartitions() >= 10 and models.compact(rows).count() == 1_000
    monkeypatch.undo()
    assert models.compact(rows).rdd.getNumPartitions() == 1
