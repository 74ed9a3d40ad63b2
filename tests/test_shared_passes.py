"""k-means, coresets, merged sums and shared folds against plain versions on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import cluster, folded, models, moments, projection, resample, search
from tallymark.operators.split import stratified_folds


def frame(spark, n=240, seed=1, d=3):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.35).astype(int)
    x = rng.normal(size=(n, d)) + 0.8 * y[:, None] * np.arange(1, d + 1)
    return spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(y, x))], "key bigint, label int, vec array<double>"), x, y


def test_tree_of_sums_adds_every_array(spark):
    rows = spark.range(1_000).repartition(40).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("value"))
    left = moments.tree_sum(rows, 40).collect()
    assert len(left) <= moments.FAN_IN and np.sum([r["value"] for r in left], axis=0).tolist() == [499_500.0, 1_000.0]


def test_cross_products_and_components(spark):
    df, x, _ = frame(spark)
    total, n = moments.cross_products(df, "vec", x.mean(axis=0))
    assert n == len(x) and total / (n - 1) == pytest.approx(np.cov(x.T))
    fitted = projection.fit_pca(df, "vec", components=3)
    rows = projection.residuals(df, fitted, "vec").collect()
    assert [r["variance"] for r in rows] == pytest.approx(np.linalg.eigvalsh(np.cov(x.T))[::-1])
    assert max(r["eigen_gap"] for r in rows) < 1e-12 and max(r["tilt"] for r in rows) < 1e-12
    wrong = projection.Components(fitted.mean, np.roll(fitted.axes, 1, axis=1), fitted.ratio, fitted.values, fitted.total)
    assert max(r["eigen_gap"] for r in projection.residuals(df, wrong, "vec").collect()) > 1e-3


def lloyd(x, centres, least):
    while True:
        own = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        if ((moved - centres) ** 2).sum() <= least:
            return centres, ((x - centres[own]) ** 2).sum()
        centres = moved


def test_starts_advance_together_as_alone(spark):
    df, x, _ = frame(spark, 300, 2)
    seeds = cluster.starting_centres(df, 4, 5)
    assert seeds.shape == (5, 4, 3) and all(any((c == row).all() for row in x) for c in seeds.reshape(-1, 3))
    starts = {(k, s): seeds[s, :k] for k in (2, 4) for s in range(5)}
    found = cluster.lloyd(df, starts)
    for name, centres in starts.items():
        want, inertia = lloyd(x, centres, cluster.TOLERANCE * x.var(axis=0).mean())
        assert found[name].centres == pytest.approx(want) and found[name].inertia == pytest.approx(inertia)
    best = cluster.kmeans(df, [2, 4], restarts=5)
    assert best[4].inertia == pytest.approx(min(found[4, s].inertia for s in range(5)))
    assert cluster.elbow(df, range(1, 4), restarts=3).filter("k = 1").first()["inertia"] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())


def test_equal_rows_and_lost_clusters(spark):
    df = spark.createDataFrame([(i, 0, [1.0, 1.0]) for i in range(9)] + [(9, 0, [5.0, 5.0])], "key bigint, label int, vec array<double>")
    best = cluster.kmeans(df, [3], restarts=2)[3]
    assert best.inertia == 0 and {r["cluster"] for r in cluster.assign(df, best.centres).collect()} <= {0, 1, 2}


def greedy(x, k):
    at, near = [0], np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(at) < k:
        near[at[-1]] = -1
        at.append(int(near.argmax()))
        near = np.where(near < 0, near, np.minimum(near, np.sqrt(((x - x[at[-1]]) ** 2).sum(axis=1))))
    return at


def radius(x, chosen):
    return max(np.sqrt(((x[:, None] - chosen[None]) ** 2).sum(axis=2)).min(axis=1))


@pytest.mark.parametrize("pool", [1, 7, 1_024])
def test_pools_choose_the_farthest_rows(spark, pool):
    df, x, _ = frame(spark, 150, 3)
    got = [r["key"] for r in resample.coreset_greedy(df, "key", "vec", 25, pool).orderBy("round").collect()]
    assert got == greedy(x, 25)


def test_coreset_of_a_thousand_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3_000, 8))
    df = spark.createDataFrame([(f"k{i:05d}", v.tolist()) for i, v in enumerate(x)], "name string, vec array<double>")
    rows = resample.coreset_greedy(df, "name", "vec", 1_000).orderBy("round").collect()
    chosen = np.array([r["vec"] for r in rows])
    assert len({r["name"] for r in rows}) == 1_000 and all(a["gap"] >= b["gap"] for a, b in zip(rows[1:], rows[2:]))
    # Greedy choice is a 2-approximation: the rows chosen and the farthest one left are a radius apart from each other.
    r = radius(x, chosen)
    apart = np.sqrt(((chosen[:, None] - chosen[None]) ** 2).sum(axis=2)) + np.eye(1_000) * 1e9
    assert apart.min() >= r - 1e-9 and rows[-1]["gap"] >= r - 1e-9
    two = resample.coreset_two_rounds(df, "name", "vec", 100, group_rows=500)
    assert two.count() == 100 and radius(x, np.array([r["vec"] for r in two.collect()])) <= 4 * radius(x, chosen[:100])


def test_coreset_of_ties_and_of_everything(spark):
    df = spark.createDataFrame([(i, [float(i % 2)]) for i in range(40)], "key bigint, vec array<double>")
    assert [r["key"] for r in resample.coreset_greedy(df, "key", "vec", 4, 3).orderBy("round").collect()] == [0, 1, 2, 3]
    assert resample.coreset_two_rounds(df, "key", "vec", -1).count() == 40


CANDIDATES = {
    "bayes": [{}, {"var_smoothing": 0.1}],
    "knn": [{"n_neighbors": 3}, {"n_neighbors": 6, "weights": "distance"}, {"n_neighbors": 4, "metric": "manhattan"}, {"n_neighbors": 5, "metric": "minkowski", "p": 3}],
    "logistic": [{"C": 0.1}, {"C": 5.0, "penalty": "l1"}, {"class_weight": "balanced"}],
}


@pytest.mark.parametrize("model", sorted(CANDIDATES))
def test_shared_folds_equal_single_fits(spark, model):
    df, _, _ = frame(spark, 160, 7)
    k = 3
    parts = search.written(stratified_folds(df, "key", "label", k))
    named = {f"c{i}": p for i, p in enumerate(CANDIDATES[model])}
    got = {(r["model"], r["key"]): r["score"] for r in folded.SHARED[model](parts, named, k).collect()}
    assert len(got) == 160 * len(named)
    for name, params in named.items():
        for fold in range(k):
            predict = models.fit(model, parts.filter(F.col("fold") != fold).drop("fold"), params)
            for r in predict(parts.filter(F.col("fold") == fold)).collect():
                assert got[name, r["key"]] == pytest.approx(r["score"], abs=2e-4 if model == "logistic" else 1e-9)


def test_newton_settles_at_zero_gradient(spark):
    df, x, y = frame(spark, 200, 8)
    for strength, l1 in ((0.01, 0.0), (0.05, 1.0)):
        w = folded.newton(df.withColumn("fold", F.lit(0)), [(None, strength, l1, False)])[0]
        chance = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        slope = np.append(x.T @ (chance - y), (chance - y).sum()) / len(y)
        if l1 == 0:
            assert np.abs(slope + np.append(strength * w[:-1], 0)).max() < 1e-9
        else:
            for s, v in zip(slope, w[:-1]):
                assert abs(s + strength * np.sign(v)) < 1e-8 if v else abs(s) <= strength + 1e-9


def test_a_fold_of_one_class_scores_that_class(spark):
    df = spark.createDataFrame([(i, 1, [float(i)], i % 2) for i in range(10)], "key bigint, label int, vec array<double>, fold int")
    for model in ("bayes", "logistic", "knn"):
        rows = folded.SHARED[model](df, {"m": {}}, 2).collect()
        assert len(rows) == 10 and all(r["prediction"] == 1 for r in rows)
