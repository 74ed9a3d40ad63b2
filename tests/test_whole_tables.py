"""Nothing is cut, clamped or dropped in silence, and large inputs stay bounded."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from queries import views
from tallymark import session
from tallymark.operators import anomaly, encode, evaluate, grid, hypothesis, models, neighbours, profile, ranking, resample, results, scale
from tallymark.plans import scenario, variants


def test_undeclared_levels_are_an_error_or_a_column(spark):
    df = spark.createDataFrame([("a", "F", 1.0), ("a", "Z", 2.0), ("b", "F", 3.0)], "r string, c string, m double")
    for run in (lambda: profile.crosstab(df, "r", "c", ["F", "O"]), lambda: results.pivot_metric(df, "r", "c", ["F", "O"], "m")):
        with pytest.raises(ValueError, match="Z"):
            run()
    assert profile.crosstab(df, "r", "c").columns == ["r", "F", "Z"]
    assert results.pivot_metric(df, "r", "c", None, "m").filter("r = 'a'").first()["Z"] == 2.0
    assert profile.crosstab(df, "r", "c", ["F", "Z", "O"]).agg(F.sum("F"), F.sum("Z"), F.sum("O")).first() == (2, 1, 0)


def test_grids_reach_from_the_first_to_the_last_day(spark, tmp_path):
    rows = [("2023-12-30 05:00:00", "view", 1.0), ("2024-02-20 23:10:00", "view", 4.0), ("2024-01-05 00:00:00", "click", 2.0)]
    df = spark.createDataFrame(rows, "t string, event_type string, value double").select(F.to_timestamp("t").alias("ts"), "event_type", "value")
    df.write.parquet(f"{tmp_path}/events.parquet")
    cells = views.grid_view(spark, str(tmp_path))
    assert cells.count() == 2 * 53 * 24 and cells.agg(F.max("x")).first()[0] == 52
    assert cells.filter("grid = 'view' and v > 0").count() == 2


def test_too_deep_trees_and_unknown_weights_are_refused(spark):
    train = spark.createDataFrame([(i, i % 2, [float(i)]) for i in range(20)], "key bigint, label int, vec array<double>")
    with pytest.raises(ValueError, match="30"):
        models.fit("tree", train, {"max_depth": 31})
    with pytest.raises(ValueError, match="class_weight"):
        models.fit("logistic", train, {"class_weight": "heavy"})
    with pytest.raises(ValueError, match="poly"):
        models.fit("svm", train, {"kernel": "poly"})


def test_class_weights_move_the_intercept_to_parity(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i < 60), [float(rng.normal(1.0 if i < 60 else 0.0))]) for i in range(600)]
    train = spark.createDataFrame(rows, "key bigint, label int, vec array<double>")
    share = lambda params, model="logistic": models.fit(model, train, params)(train).agg(F.avg(F.col("prediction").cast("double"))).first()[0]
    assert share({}) < 0.05 and 0.25 < share({"class_weight": "balanced"}) < 0.5
    assert share({"max_depth": 2}, "tree") < 0.1 < share({"max_depth": 2, "class_weight": "balanced"}, "tree")
    # The gradient of the weighted loss is zero at the fitted weights: residuals balance.
    scored = models.fit("logistic", train, {"class_weight": "balanced", "C": 1e9})(train).join(train.select("key", "vec"), "key")
    weight = F.when(F.col("label") == 1, 600 / 120).otherwise(600 / 1080)
    sums = scored.agg(F.sum(weight * (F.col("label") - F.col("score"))), F.sum(weight * (F.col("label") - F.col("score")) * F.col("vec")[0])).first()
    assert all(abs(s) < 1e-2 for s in sums)


def test_session_spaces_and_fixed_parameters(spark):
    from tallymark.operators import search

    rng = np.random.default_rng(5)
    rows = [(i, i % 2, float(rng.normal(i % 2)), float(rng.normal())) for i in range(80)]
    frame = scenario.Frame(spark.createDataFrame(rows, "key bigint, label int, a double, b double"), ["a", "b"])
    engine, best = scenario._tuned(frame, "tree", ("tree", {"max_depth": 2}), search.SESSION_SPACES, 2, 2)
    assert engine == "tree" and best["max_depth"] == 2 and set(best) == set(search.SESSION_SPACES["tree"])
    with pytest.raises(ValueError, match="no parameter space"):
        scenario._tuned(frame, "other", ("perceptron", {}), search.SESSION_SPACES, 2, 2)
    out = scenario.four_scenarios(frame, {"tree": ("tree", {})}, trials=2, tuning_folds=2, spaces=search.SESSION_SPACES)
    assert out.count() == 4


def test_counts_beyond_bigint_products(spark):
    big = 5 * 10**9
    # Sums of columns stand in for counts of that many rows.
    many = spark.createDataFrame([(big, 1), (big // 2, 0), (0, 1)], "a bigint, y bigint")
    assert hypothesis.chi2_binary(many, ["a"], "y").count() == 1
    tall = spark.createDataFrame([("g", i, 0, v) for i, v in enumerate([0, 0, 10, 250, 255])], "grid string, x int, y int, v int")
    assert grid.otsu_threshold(tall).first()["threshold"] == 10


def test_a_row_without_a_score_is_an_error(spark):
    df = spark.createDataFrame([(0.1, 0), (None, 1)], "s double, y int")
    with pytest.raises(Exception, match="without a score"):
        evaluate.roc_auc(df, "s", "y").collect()


def test_wide_values_of_every_type_are_never_small(spark):
    long = "'" + "x" * 5_000 + "'"
    for value in (long, f"encode({long}, 'UTF-8')", f"struct({long} as a)", f"map('k', {long})", f"array({long})", "sequence(1, 5000)"):
        assert session.few_rows(spark.range(2).selectExpr(f"{value} as v")) is None, value
    for value in ("'x'", "struct(1 as a)", "map('k', 'v')", "array('x')", "cast(null as struct<a:int>)"):
        assert len(session.few_rows(spark.range(2).selectExpr(f"{value} as v"))) == 2, value


def test_levels_with_one_outlier_are_spread(spark, monkeypatch):
    monkeypatch.setattr(session, "SMALL_ROWS", 10)
    names = ["a"] + [f"http://example.com/page/{i:05d}" for i in range(3_000)] + ["é", "zz", ""]
    df = spark.createDataFrame([(n,) for n in names], "level string").repartition(7)
    codes = {r["level"]: r["code"] for r in encode.fit_dictionary(df, "level").collect()}
    assert codes == {n: i for i, n in enumerate(sorted(names, key=str.encode))}


def test_quantiles_rank_many_bracket_values_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SKETCH_ROWS", 20)
    monkeypatch.setattr(session, "SMALL_ROWS", 50)
    rng = np.random.default_rng(1)
    x = rng.normal(size=4_000).round(3)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(x)], "g int, x double").repartition(6)
    found = ranking.quantile_row(df, ["x"], {"a": 0.02, "b": 0.5, "c": 0.98})["x"]
    assert np.allclose([found[k] for k in "abc"], np.quantile(x, [0.02, 0.5, 0.98]))
    by = {r["g"]: r["m"] for r in ranking.exact_quantiles(df, ["x"], {"m": 0.5}, by=["g"]).collect()}
    assert np.allclose([by[0], by[1]], [np.median(x[0::2]), np.median(x[1::2])])


def test_a_fit_reads_its_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    df = spark.range(100).select(F.col("id").cast("double").alias("x")).mapInPandas(tick, "x double")
    for fit in (scale.fit_standard, scale.fit_minmax):
        before = reads.value
        fitted = fit(df, ["x"])
        for _ in range(3):
            scale.transform(spark.createDataFrame([(1.0,)], "x double"), fitted, ["x"]).collect()
        assert reads.value - before == 100


def test_neighbours_with_text_keys_and_pivots(spark):
    rng = np.random.default_rng(2)
    rows = [(f"k{i:03d}", i % 2, [float(v) for v in rng.normal(size=3)]) for i in range(80)]
    df = spark.createDataFrame(rows, "key string, label int, vec array<double>")
    plain = {(r["left_key"], r["right_key"], r["rank"]) for r in neighbours.knn_join(df, df, 3, "key", "key", exclude_self=True).collect()}
    vec = np.array([r[2] for r in rows])
    gap = np.sqrt(((vec[:, None] - vec[None]) ** 2).sum(-1))
    np.fill_diagonal(gap, np.inf)
    assert plain == {(rows[i][0], rows[j][0], n + 1) for i in range(80) for n, j in enumerate(np.argsort(gap[i])[:3])}
    assert {(r["left_key"], r["right_key"], r["rank"]) for r in neighbours.knn_join(df, df, 3, "key", "key", exclude_self=True, pivots=6).collect()} == plain
    votes = lambda **o: sorted(map(tuple, neighbours.knn_classify(df, df, 3, "key", "label", **o).collect()))
    assert votes() == votes(pivots=6)
    scores = lambda **o: sorted((r["key"], round(r["score"], 9)) for r in anomaly.memory_bank_score(df, df, "key", "vec", 3, **o).collect())
    assert scores() == scores(pivots=6)
    numbered = spark.createDataFrame([(i, int(i < 20), r[2]) for i, r in enumerate(rows)], "key bigint, label int, vec array<double>")
    made = lambda **o: sorted(map(str, resample.smote(numbered, "key", "label", "vec", **o).collect()))
    assert made() == made(pivots=4)


# Grid variants


def square(n, inside=200):
    return [("g", x, y, inside if 20 <= x < 40 and 18 <= y < 36 else 5) for x in range(n) for y in range(n)]


def test_crop_then_blur_mirrors_at_the_new_edge(spark):
    df = spark.createDataFrame(square(60), "grid string, x int, y int, v int")
    out = variants.prepare(df, {"crop": 3, "denoise": "gaussian"}).toPandas()
    box = grid.crop_to_foreground(df, 3).toPandas()
    w, h = box.x.max() - box.x.min() + 1, box.y.max() - box.y.min() + 1
    assert (out.x.min(), out.y.min(), out.x.max(), out.y.max(), len(out)) == (0, 0, w - 1, h - 1, w * h)
    m = box.pivot(index="y", columns="x", values="v").to_numpy().astype(float)
    p = np.pad(m, 2, mode="reflect")
    want = sum(grid.GAUSSIAN_5[i, j] * p[i : i + h, j : j + w] for i in range(5) for j in range(5))
    assert (out.pivot(index="y", columns="x", values="v").to_numpy() == np.floor(want + 0.5)).all()
    # The operator itself keeps the places of a grid that does not begin at (0, 0).
    moved = grid.gaussian_blur(grid.crop_to_foreground(df, 3)).toPandas()
    assert moved.x.min() == box.x.min() and moved.y.max() == box.y.max() and len(moved) == w * h


def test_channels_stay_apart_through_all_steps(spark):
    rows = [(g, x, y, c, (v * k) % 256) for g, x, y, v in square(44) for c, k in (("r", 1), ("g", 2), ("b", 3))]
    df = spark.createDataFrame(rows, "grid string, x int, y int, channel string, v int")
    blurred = variants.prepare(df, {"denoise": "gaussian"})
    assert blurred.count() == len(rows)
    for c in "rgb":
        one = df.filter(F.col("channel") == c).drop("channel")
        a = sorted(map(tuple, blurred.filter(F.col("channel") == c).select("grid", "x", "y", "v").collect()))
        assert a == sorted(map(tuple, grid.gaussian_blur(one).select("grid", "x", "y", "v").collect()))
    config = {"crop": 2, "channel_balance": True, "gamma": 1.2, "denoise": "median", "equalize": True, "sharpen": 1.0, "luma": True, "normalize": "minmax"}
    out = variants.run_variants(df, {"a": config, "b": {"equalize": True}})
    sizes = {r["variant"]: r["count"] for r in out.groupBy("variant").count().collect()}
    assert sizes["b"] == len(rows) and 0 < sizes["a"] < 44 * 44
    assert out.filter("v < 0 or v > 255 or v is null").count() == 0


def test_normalisation_methods_differ_and_unknown_ones_are_refused(spark):
    df = spark.createDataFrame([("g", x, 0, v) for x, v in enumerate([0, 1, 2, 3, 50, 60, 250])], "grid string, x int, y int, v int")
    got = {m: [r["v"] for r in variants.prepare(df, {"normalize": m}).orderBy("x").collect()] for m in ("minmax", "robust")}
    assert got["minmax"] != got["robust"] and got["minmax"][-1] == 254
    for config in ({"normalize": "other"}, {"denoise": "other"}, {"equalize": "yes"}):
        with pytest.raises(ValueError):
            variants.prepare(df, config)
