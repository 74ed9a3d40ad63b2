"""Neighbour joins, imputation and the approximate join against plain numpy on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import impute, neighbours


def clustered(spark, n, d, centres, seed, spread=0.05, text=False):
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(77).normal(size=(centres, d)) * 3
    rows = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, d)) * spread
    keys = [f"img/{i:05d}.bmp" if text else i for i in range(n)]
    kind = "string" if text else "bigint"
    return spark.createDataFrame([(k, r.tolist()) for k, r in zip(keys, rows)], f"key {kind}, vec array<double>"), keys, rows


def nearest(left, right, right_keys, k, p=2):
    out = []
    for x in left:
        gap = np.zeros(len(right))
        for j in range(right.shape[1]):
            gap += np.abs(x[j] - right[:, j]) ** p
        out.append([right_keys[i] for i in sorted(range(len(right)), key=lambda i: (gap[i], right_keys[i]))[:k]])
    return out


def pairs_of(df):
    out = {}
    for r in df.orderBy("left_key", "rank").collect():
        out.setdefault(r["left_key"], []).append(r["right_key"])
    return out


@pytest.mark.parametrize("p", [1, 2, 3])
def test_text_keys_and_blocks(spark, p):
    left, lk, a = clustered(spark, 60, 3, 5, 1, text=True)
    right, rk, b = clustered(spark, 200, 3, 5, 2, text=True)
    got = pairs_of(neighbours.knn_join(left, right, 4, "key", "key", p=p, block_rows=17))
    assert got == dict(zip(lk, nearest(a, b, rk, 4, p)))


def test_ties_and_repeats_go_by_key(spark):
    right = spark.createDataFrame([(i, [float(i % 2)]) for i in range(50)], "key bigint, vec array<double>")
    got = pairs_of(neighbours.knn_join(right.filter("key < 4"), right, 3, "key", "key", exclude_self=True))
    assert got == {0: [2, 4, 6], 1: [3, 5, 7], 2: [0, 4, 6], 3: [1, 5, 7]}


def test_measured_pivots_pay_only_where_they_skip_rows(spark, monkeypatch):
    left, lk, a = clustered(spark, 300, 4, 12, 3)
    right, rk, b = clustered(spark, 3_000, 4, 12, 4)
    sides = [df.select("key", F.col("vec").alias("v")) for df in (left, right)]
    shapes = ((300, 4), (3_000, 4))
    assert neighbours.pivot_count(*sides, shapes, 5, 2) == 0
    monkeypatch.setattr(neighbours, "PIVOT_PASSES", 1_000)
    assert neighbours.pivot_count(*sides, shapes, 5, 2) > 0
    assert pairs_of(neighbours.knn_join(left, right, 5, "key", "key")) == dict(zip(lk, nearest(a, b, rk, 5)))


def recall(got, want):
    return sum(len(set(got[k]) & set(w)) for k, w in want.items()) / sum(map(len, want.values()))


def test_lsh_finds_nine_tenths_of_spread_and_clustered_rows(spark):
    for centres, spread, d in ((1, 1.0, 8), (40, 0.3, 16)):
        left, lk, a = clustered(spark, 250, d, centres, 5, spread)
        right, rk, b = clustered(spark, 2_500, d, centres, 6, spread)
        got = pairs_of(neighbours.knn_join_lsh(left, right, 5, "key", "key"))
        want = dict(zip(lk, nearest(a, b, rk, 5)))
        assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
        assert recall(got, want) >= 0.9


def test_lsh_compares_hot_buckets_whole(spark):
    # A third of the rows lie in one spot, some left rows far from everything: exact neighbours all the same.
    right, rk, b = clustered(spark, 600, 4, 3, 8, 1.0)
    hot = spark.createDataFrame([(10_000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(400)], "key bigint, vec array<double>")
    left = spark.createDataFrame([(1, [0.5, 0.5, 0.5, 0.5]), (2, [500.0, 0.0, 0.0, 0.0])] + [(10 + i, r.tolist()) for i, r in enumerate(b[:60])], "key bigint, vec array<double>")
    both = right.unionByName(hot)
    got = pairs_of(neighbours.knn_join_lsh(left, both, 3, "key", "key", block_rows=50))
    want = pairs_of(neighbours.knn_join(left, both, 3, "key", "key", pivots=0))
    assert got[1] == [10_000, 10_001, 10_002] and len(got[2]) == 3 and recall(got, want) >= 0.9


def test_lsh_of_nothing_and_of_few_rows(spark):
    left, _, _ = clustered(spark, 5, 3, 1, 9)
    assert neighbours.knn_join_lsh(left.limit(0), left, 2, "key", "key").count() == 0
    assert neighbours.knn_join_lsh(left, left.limit(0), 2, "key", "key").count() == 0
    assert neighbours.knn_join_lsh(left, left.filter("key < 2"), 3, "key", "key").count() == 10


def test_collision_chance_matches_draws():
    rng = np.random.default_rng(3)
    for distance in (0.5, 1.0, 4.0):
        step = rng.normal(size=200_000) * distance
        place = rng.uniform(0, 1, 200_000)
        drawn = (np.floor(place + step / 2.0) == np.floor(place)).mean()
        assert neighbours.collision(np.array([distance]), 2.0)[0] == pytest.approx(drawn, abs=0.01)


def imputed(rows, k):
    """rows: {key: values with None}; the contract in plain Python."""
    width = len(next(iter(rows.values())))
    means = [np.mean([v[j] for v in rows.values() if v[j] is not None]) for j in range(width)]
    out = {}
    for key, v in rows.items():
        filled = list(v)
        for j in range(width):
            if v[j] is not None:
                continue
            found = []
            for other, w in rows.items():
                shared = [i for i in range(width) if v[i] is not None and w[i] is not None]
                if w[j] is not None and shared:
                    found.append((np.sqrt(width / len(shared) * sum((v[i] - w[i]) ** 2 for i in shared)), other, w[j]))
            filled[j] = np.mean([x[2] for x in sorted(found)[:k]]) if found else means[j]
        out[key] = filled
    return out


@pytest.mark.parametrize("most", [64, 2])
def test_imputation_with_text_keys_and_donors_with_gaps(spark, monkeypatch, most):
    monkeypatch.setattr(impute, "MAX_PATTERNS", most)
    rng = np.random.default_rng(12)
    rows = {f"k{i:03d}": [None if rng.random() < 0.2 else float(x) for x in rng.normal(size=3)] for i in range(150)}
    rows["empty"], rows["far"] = [None, None, None], [1e9, None, 1.0]
    df = spark.createDataFrame([(k, *v) for k, v in rows.items()], "key string, a double, b double, c double")
    got = {r["key"]: [r["a"], r["b"], r["c"]] for r in impute.impute_knn(df, "key", ["a", "b", "c"], 4).collect()}
    for key, want in imputed(rows, 4).items():
        assert got[key] == pytest.approx(want), key


@pytest.mark.parametrize("pairs", [10**9, 0])
def test_donors_with_gaps_are_compared_only_where_they_help(spark, monkeypatch, pairs):
    # Rows without b and c lack what such rows want, so they are not compared with each other.
    met = []
    block = impute.block_join
    monkeypatch.setattr(impute, "block_join", lambda left, right, *a: met.append((left.count(), right.count())) or block(left, right, *a))
    monkeypatch.setattr(impute, "MANY_PAIRS", pairs)
    rng = np.random.default_rng(4)
    alike = {i: [float(x), None, None] if i < 60 else [float(x), float(y), float(z)] for i, (x, y, z) in enumerate(rng.normal(size=(200, 3)))}
    mixed = {**alike, **{300 + i: [None, float(y), float(z)] if i % 2 else [float(y), float(z), None] for i, (y, z) in enumerate(rng.normal(size=(40, 2)))}}
    for rows, blocks in ((alike, []), (mixed, [(60 + 40, 40)] if pairs else [])):
        met.clear()
        df = spark.createDataFrame([(k, *v) for k, v in rows.items()], "key bigint, a double, b double, c double")
        got = {r["key"]: [r["a"], r["b"], r["c"]] for r in impute.impute_knn(df, "key", ["a", "b", "c"], 4).collect()}
        for key, want in imputed(rows, 4).items():
            assert got[key] == pytest.approx(want), key
        assert met == blocks


def cells_of(spark, monkeypatch, rows):
    """Cells of a few rows; returns a list of the pairs that each pass compares at most."""
    passes = []
    join = neighbours._join_cells
    monkeypatch.setattr(neighbours, "_join_cells", lambda *a: passes.append(sum(x * y for x, y in zip(a[2], a[3]))) or join(*a))
    monkeypatch.setattr(neighbours, "CELL_ROWS", rows)
    monkeypatch.setattr(neighbours, "PIVOT_PASSES", 1)
    return passes


@pytest.mark.parametrize("p", [1.0, 2.0, 3.0])
@pytest.mark.parametrize("width, centres", [(2, 1), (6, 5)])
def test_cells_find_the_exact_neighbours(spark, monkeypatch, p, width, centres):
    passes = cells_of(spark, monkeypatch, 20)
    left, lk, a = clustered(spark, 300, width, centres, 1)
    right, rk, b = clustered(spark, 2_000, width, centres, 2)
    right = right.unionByName(spark.createDataFrame([(9_000_000 + i, [0.0] * width) for i in range(300)], "key bigint, vec array<double>"))
    left = left.unionByName(spark.createDataFrame([(8_000_000, [1e6] * width)], "key bigint, vec array<double>"))
    got = neighbours.knn_join(left, right, 5, "key", "key", p=p, block_rows=100)
    want = neighbours.knn_join(left, right, 5, "key", "key", p=p, pivots=0)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(passes) >= 2 and passes[0] < 301 * 2_300 / 10


@pytest.mark.parametrize("width", [2, 3])
def test_compared_pairs_of_a_left_row_stay_the_same_as_the_right_side_grows(spark, monkeypatch, width):
    pairs = []
    for n in (2_000, 16_000):
        with monkeypatch.context() as patch:
            passes = cells_of(spark, patch, 20)
            left, _, _ = clustered(spark, 200, width, 1, 3)
            right, _, _ = clustered(spark, n, width, 1, 4)
            neighbours.knn_join(left, right, 5, "key", "key").count()
            pairs.append(sum(passes[:2]))
    assert pairs[1] < 2 * pairs[0]


def test_cells_keep_folds_apart_and_skip_the_row_itself(spark, monkeypatch):
    cells_of(spark, monkeypatch, 20)
    df, _, _ = clustered(spark, 900, 3, 4, 7)
    # One cluster lies in fold 0 alone, so its own cell has no neighbour for it.
    lone = spark.createDataFrame([(5_000 + i, [90.0 + i / 100, 90.0, 90.0]) for i in range(120)], "key bigint, vec array<double>")
    df = df.withColumn("fold", (F.col("key") % 3).cast("int")).unionByName(lone.withColumn("fold", F.lit(0)))
    for options in ({"apart": "fold"}, {"exclude_self": True}, {"apart": "fold", "exclude_self": True}):
        got = neighbours.knn_join(df, df, 4, "key", "key", **options)
        want = neighbours.knn_join(df, df, 4, "key", "key", pivots=0, **options)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_cells_with_repeated_and_null_keys_and_odd_numbers(spark, monkeypatch):
    cells_of(spark, monkeypatch, 20)
    df, _, _ = clustered(spark, 500, 2, 3, 9)
    # Keys that are null lie beside other rows, not on them: no order of null among equal distances is promised.
    lost = df.filter("key % 70 = 0").select(F.lit(None).cast("bigint").alias("key"), F.transform("vec", lambda x: x + 0.001).alias("vec"))
    more = df.filter("key % 50 = 0").unionByName(lost)
    df = df.unionByName(more)
    nan = spark.createDataFrame([(7_000, [float("nan"), 1.0])], "key bigint, vec array<double>")
    monkeypatch.setattr(neighbours, "pivot_count", lambda *a: 0)  # what cells leave to the other ways is compared whole
    for left, right in ((df, df), (df, df.unionByName(nan))):
        got = neighbours.knn_join(left, right, 3, "key", "key")
        want = neighbours.knn_join(left, right, 3, "key", "key", pivots=0)
        order = lambda rows: sorted(map(tuple, rows), key=str)
        assert order(got.collect()) == order(want.collect())
