"""Hand-computed results, edge cases and errors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.functions.rng import u
from tallymark.operators import (
    anomaly, columns, encode, evaluate, features, grid, hypothesis, impute, models, profile, ranking, resample, results, scale, search,
    split,
)
from tallymark.plans import scenario, variants
from tallymark.sources import files, tables

SIX = [1.0, 2.0, 2.0, 10.0, 4.0, 6.0]


@pytest.fixture(scope="module")
def six(spark):
    labels = [0, 1, 0, 1, 0, 1]
    return spark.createDataFrame([(i, v, y) for i, (v, y) in enumerate(zip(SIX, labels))], "id bigint, x double, y int")


def values(df, column, key="id"):
    return [r[column] for r in df.orderBy(key).collect()]


def test_hash_draw(spark):
    assert spark.range(42, 43).select(u("id", "7").alias("u")).first()["u"] == 0.4643532645622859


def test_standard_scale_uses_population_deviation(six):
    assert math.isclose(scale.fit_standard(six, ["x"]).first()["x__scale"], 3.0776975521, rel_tol=1e-9)


def test_robust_scale(six):
    fitted = scale.fit_robust(six, ["x"]).first()
    assert (fitted["x__shift"], fitted["x__scale"]) == (3.0, 3.5)


def test_constant_column_is_not_divided_by_zero(spark):
    flat = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id bigint, x double")
    assert values(scale.transform(flat, scale.fit_standard(flat, ["x"]), ["x"]), "x") == [0.0, 0.0]
    assert values(scale.minmax_within(flat.withColumn("g", F.lit(1)), "g", "x"), "x") == [0.0, 0.0]


@pytest.mark.parametrize("n, low, high", [(20, 2.0, 19.0), (10, 1.0, 10.0)])
def test_winsorize(spark, n, low, high):
    df = spark.range(1, n + 1).select("id", F.col("id").cast("double").alias("x"))
    clipped = values(features.winsorize(df, ["x"]), "x")
    assert min(clipped) == low and max(clipped) == high and clipped[3] == 4.0


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0, 40, 41, 55, 70, 100, 101])], "id bigint, x int")
    edges = [0, 40, 55, 70, 100]
    assert values(df.withColumn("b", features.bin_right_closed("x", edges)), "b") == [None, 0, 1, 1, 2, 3, None]
    assert values(df.withColumn("b", features.bin_right_closed("x", edges, 1)), "b") == [1, 0, 1, 1, 2, 3, 1]


def test_label_codes(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a"), (3, "c")], "id bigint, x string")
    assert values(encode.label_encode(df, ["x"], "missing"), "x") == [1, 3, 0, 2]


def test_unseen_level_is_an_error(spark):
    known = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(Exception, match="not fitted"):
        encode.apply_dictionary(spark.createDataFrame([("z",)], "x string"), "x", encode.fit_dictionary(known, "x")).collect()


def test_many_levels_are_ranked_on_the_cluster(spark, monkeypatch):
    monkeypatch.setattr("tallymark.session.SMALL_ROWS", 5)
    df = spark.range(300).select("id", F.concat(F.lit("user_"), F.col("id").cast("string")).alias("x"))
    codes = values(encode.label_encode(df, ["x"]), "x")
    names = sorted(f"user_{i}" for i in range(300))
    assert codes == [names.index(f"user_{i}") for i in range(300)]


def test_one_hot_drops_the_first_level(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id bigint, x string")
    wide = encode.one_hot(df, ["x"])
    assert wide.columns == ["id", "x_b", "x_c"] and [tuple(r)[1:] for r in wide.orderBy("id").collect()] == [(0, 0), (1, 0), (0, 1)]


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("x",), (None,)], "v string")
    assert impute.fit_mode(df, ["v"]) == {"v": "x"}


def test_neighbour_imputation(spark):
    df = spark.createDataFrame([(0, 1.0, None), (1, 1.0, 2.0), (2, 2.0, 4.0), (3, 10.0, 20.0)], "id bigint, a double, b double")
    assert values(impute.impute_knn(df, "id", ["a", "b"], k=2), "b")[0] == 3.0


def test_neighbour_imputation_without_donor_uses_the_mean(spark):
    df = spark.createDataFrame([(0, None, None), (1, 1.0, 2.0), (2, 3.0, 4.0)], "id bigint, a double, b double")
    assert impute.impute_knn(df, "id", ["a", "b"], k=2).orderBy("id").first()[1:] == (2.0, 3.0)


def test_welch(six):
    row = hypothesis.welch_ttest(six.filter("true"), ["x"], "y").first()
    assert math.isclose(row["t"], 1.4832396974, rel_tol=1e-9) and math.isclose(row["df"], 2.5711857204, rel_tol=1e-9)


def test_anova_equals_hand_computed(six):
    assert math.isclose(hypothesis.anova_f(six, ["x"], "y").first()["f"], 2.2, rel_tol=1e-9)


def test_chi_square_with_and_without_correction(spark):
    cells = [(1, 1)] * 10 + [(1, 0)] * 10 + [(0, 1)] * 10 + [(0, 0)] * 17
    df = spark.createDataFrame(cells, "a int, y int")
    assert math.isclose(hypothesis.chi2_binary(df, ["a"], "y").first()["chi2"], 0.3485108025, rel_tol=1e-8)
    assert math.isclose(hypothesis.chi2_binary(df, ["a"], "y", yates=False).first()["chi2"], 0.7897805213, rel_tol=1e-8)
    assert math.isclose(hypothesis.chi2_general(df, "a", "y").first()["chi2"], 0.7897805213, rel_tol=1e-8)


def test_p_values_against_published_tables(spark):
    # Two-sided 5 % points of t and upper 5 % points of chi-square, as printed in statistical tables.
    t = spark.createDataFrame([(12.706, 1.0), (2.228, 10.0), (1.984, 100.0)], "t double, df double")
    assert all(abs(r["p"] - 0.05) < 2e-4 for r in hypothesis.with_t_pvalue(t).collect())
    chi = spark.createDataFrame([(3.841, 1), (18.307, 10), (124.342, 100)], "chi2 double, dof int")
    assert all(abs(r["p"] - 0.05) < 2e-4 for r in hypothesis.with_chi2_pvalue(chi).collect())


def test_auc_and_threshold_with_ties(spark):
    scores = list(zip([0.9, 0.8, 0.8, 0.4, 0.3], [1, 1, 0, 0, 1]))
    df = spark.createDataFrame(scores, "s double, y int")
    assert math.isclose(evaluate.roc_auc(df, "s", "y").first()["auc"], 0.5833333333, rel_tol=1e-9)
    best = evaluate.youden_threshold(df, "s", "y").first()
    assert best["threshold"] == 0.9 and math.isclose(best["j"], 1 / 3)


def test_auc_of_one_class_is_the_given_default(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert evaluate.roc_auc(df, "s", "y", undefined=0.0).first()["auc"] == 0.0


def test_metrics_without_a_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    row = evaluate.binary_metrics(df, "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_localisation_score(spark):
    maps = {("d", 1): [0.2, 0.9, 0.8, 0.1], ("g", 0): [0.0, 0.1, 0.3, 1.0]}
    rows = [(i, y, v) for (i, y), cells in maps.items() for v in cells]
    df = spark.createDataFrame(rows, "item string, y int, v double")
    assert abs(evaluate.aupro_approx(df, "item", "v", "y").first()["aupro"] - 0.4904040) < 1e-6
    assert evaluate.aupro_approx(df.withColumn("v", F.lit(0.3)), "item", "v", "y").first()["aupro"] == 0.5
    assert evaluate.aupro_approx(df.withColumn("y", F.lit(0)), "item", "v", "y").first()["aupro"] == 0.0


def test_coreset_takes_the_farthest_rows(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (5, [5.0]), (9, [9.0])], "id bigint, vec array<double>")
    chosen = resample.coreset_greedy(df, "id", "vec", 3, pool=1)
    assert [r["id"] for r in chosen.orderBy("round").collect()] == [0, 9, 5]
    assert resample.coreset_greedy(df, "id", "vec", -1).count() == 4


def test_split_sizes(spark):
    df = spark.range(14).select("id", (F.col("id") >= 10).cast("int").alias("y"))
    sizes = {r["y"]: r["n"] for r in split.stratified_split(df, "id", "y", 0.3).filter("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 3, 1: 1}


def test_fold_sizes(spark):
    df = spark.range(12).select("id", F.lit(0).alias("y"))
    folds = split.stratified_folds(df, "id", "y", 5).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == [3, 3, 2, 2, 2]
    ordered = split.stratified_folds(df, "id", "y", 5, shuffle=False)
    assert values(ordered, "fold") == [i % 5 for i in range(12)]


def test_oversampling_reaches_parity_between_neighbours(spark):
    rows = [(i, 0, [float(i), 0.0]) for i in range(30)] + [(100 + i, 1, [float(i), 1.0]) for i in range(4)]
    made = resample.smote(spark.createDataFrame(rows, "id bigint, y int, vec array<double>"), "id", "y", "vec")
    assert {r["y"]: r["count"] for r in made.groupBy("y").count().collect()} == {0: 30, 1: 30}
    fresh = made.filter("synthetic").collect()
    assert len({r["id"] for r in fresh}) == 26 and all(0 <= r["vec"][0] <= 3 and r["vec"][1] == 1.0 for r in fresh)


def test_oversampling_in_large_mode_gives_the_same_rows(spark, monkeypatch):
    rows = [(i, 0, [float(i * i % 17), 0.0]) for i in range(40)] + [(100 + i, 1, [float(i), 1.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "id bigint, y int, vec array<double>")
    small_mode = {(r["id"], tuple(r["vec"])) for r in resample.smote(df, "id", "y", "vec").collect()}
    monkeypatch.setattr("tallymark.session.SMALL_ROWS", 2)
    assert {(r["id"], tuple(r["vec"])) for r in resample.smote(df, "id", "y", "vec").collect()} == small_mode


def test_class_weight(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert {r["y"]: r["weight"] for r in split.class_weight(df, "y").collect()} == {0: 4 / 6, 1: 2.0}


def test_noise_parts_follow_key_order(spark):
    df = spark.range(10).select("id", F.array(*[F.lit(0.0)] * 400).alias("vec"))
    spread = [np.std(r["noised"]) for r in resample.noised(df, "id", "vec", 1.0).orderBy("id").collect()]
    assert max(spread[:3]) < 0.6 and 0.85 < min(spread[3:6]) < 1.15 and min(spread[6:]) > 1.7


def test_filter_on_an_absent_column_passes(six):
    assert columns.filter_equal(six, "nothing", 1).count() == 6


def test_thresholds_inclusive_and_strict(six):
    marked = six.select("id", columns.predict_at("x", 2.0).alias("a"), columns.predict_at("x", 2.0, strict=True).alias("b"))
    assert values(marked, "a") == [0, 1, 1, 1, 1, 1] and values(marked, "b") == [0, 0, 0, 1, 1, 1]


def test_histogram_closes_the_last_bin(six):
    bins = profile.histogram(six, "x", 3).orderBy("bin").collect()
    # Bins of width 3 from 1: (1, 2, 2), (4, 6) and the maximum itself.
    assert [r["n"] for r in bins] == [3, 2, 1] and bins[-1]["right"] == 10.0


def test_box_outliers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 100]], "g string, x double")
    row = profile.box_stats(df, "x", "g").first()
    assert (row["q1"], row["median"], row["q3"], row["low_whisker"], row["high_whisker"], row["outliers"]) == (2, 3, 4, 1, 4, 1)


def test_fold_summary_leaves_failed_folds_out(spark):
    df = spark.createDataFrame([("m", 0.5), ("m", None), ("m", 0.7)], "model string, f1 double")
    row = results.fold_summary(df, ["model"], "f1").first()
    assert math.isclose(row["f1_mean"], 0.6) and row["folds"] == 2 and row["f1_text"] == "0.600±0.100"


def test_parameter_grid_is_numbered_in_axis_order(spark):
    rows = results.param_grid(spark, {"a": [1, 2], "b": ["x", "y", "z"]}).orderBy("experiment").collect()
    assert [tuple(r) for r in rows][:4] == [(1, 1, "x"), (2, 1, "y"), (3, 1, "z"), (4, 2, "x")] and len(rows) == 6


def test_every_space_stays_in_range(spark):
    for spaces in (search.SESSION_SPACES, search.ABLATION_SPACES, search.EARLIER_FOREST_SPACES):
        for space in spaces.values():
            for row in search.trial_table(spark, space, 25).collect():
                for name, spec in space.items():
                    inside = row[name] in spec[1] if spec[0] == "level" else spec[1] <= row[name] <= spec[2]
                    assert inside, (name, row[name])


def test_parameters_without_a_counterpart_are_reported():
    assert models.ignored_parameters("boosting", {"num_leaves": 31, "learning_rate": 0.1}) == ["num_leaves"]


def test_models_separate_two_clouds(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 2, [float(v) for v in rng.normal(3.0 * (i % 2), 1.0, 3)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "key bigint, label int, vec array<double>")
    for name in models.FITTERS:
        scored = models.fit(name, frame, {"n_estimators": 5} if name in ("forest", "boosting") else {})(frame)
        assert scored.filter("label = prediction").count() > 270, name


def test_leak_safe_scenarios_differ_from_the_others_only_in_where_steps_are_fitted(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(i % 5 == 0), *[float(v) for v in rng.normal(2.0 * (i % 5 == 0), 1.0, 2)]) for i in range(120)]
    frame = scenario.Frame(spark.createDataFrame(rows, "key bigint, label int, a double, b double"), ["a", "b"])
    spec = {"s": scenario.Scenario(("scale_standard", scenario.RESAMPLE))}
    candidates = {"bayes": ("bayes", {})}
    safe = scenario.compare(frame, spec, candidates, folds=2).agg(F.sum(F.expr("tn+fp+fn+tp"))).first()[0]
    leaky = scenario.compare(frame, spec, candidates, folds=2, leak_safe=False).agg(F.sum(F.expr("tn+fp+fn+tp"))).first()[0]
    # Safe folds hold out real rows only; the others also hold out the synthetic ones.
    assert safe == 120 and leaky == 192


def test_anomaly_evaluation_on_separate_rows(spark):
    tune = spark.createDataFrame([(0.0, 0), (0.2, 0), (0.8, 1), (1.0, 1)], "s double, y int")
    test = spark.createDataFrame([(0.1, 0), (0.9, 1), (0.85, 0)], "s double, y int")
    row = anomaly.evaluate_scores(tune, test, "s", "y").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 1, 0, 1)


def test_crop_keeps_the_bright_box_and_its_margin(spark):
    rows = [("g", x, y, 200.0 if 20 <= x <= 30 and 25 <= y <= 28 else 5.0) for x in range(60) for y in range(50)]
    cropped = grid.crop_to_foreground(spark.createDataFrame(rows, "grid string, x int, y int, v double"), margin=3)
    box = cropped.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    assert tuple(box) == (17, 33, 22, 31)


def test_variants_reject_unknown_steps(spark):
    with pytest.raises(ValueError, match="unknown"):
        variants.prepare(spark.range(1), {"blurr": True})


def test_csv_needs_a_schema_and_a_path(spark, tmp_path):
    with pytest.raises(ValueError, match="schema"):
        tables.read_table(spark, str(tmp_path), "csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.read_table(spark, str(tmp_path / "none.csv"), "csv", "a int").collect()


def test_runs_sit_side_by_side(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, n in (("a", 2), ("b", 3), ("a", 1)):
        tables.write_table(spark.range(n), path, "parquet", run_id=run)
    found = {r["run_id"]: r["count"] for r in tables.read_table(spark, path).groupBy("run_id").count().collect()}
    assert found == {"a": 1, "b": 3}


def test_file_catalogue(spark, tmp_path):
    for part in ("train/good/1.bmp", "test/defect/2.BMP", "test/good/3.bmp", "test/good/note.txt"):
        (tmp_path / part).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / part).write_bytes(b"x")
    found = files.catalog(files.list_files(spark, str(tmp_path), "*.bmp")).orderBy("filename").collect()
    assert [(r["type"], r["label"], r["filename"]) for r in found] == [("train", "good", "1.bmp"), ("test", "good", "3.bmp")]
    counts = files.count_by_folder(files.list_files(spark, str(tmp_path), "*"), [".bmp"])
    assert sorted(r["n"] for r in counts.collect()) == [1, 1, 1]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    data = [(int(i % 3), float(v)) for i, v in enumerate(rng.exponential(10, 2000).round(1))]
    found = ranking.exact_quantiles(spark.createDataFrame(data, "g int, x double"), ["x"], {"p": 0.02, "q": 0.7}, by=["g"])
    for row in found.collect():
        mine = [v for g, v in data if g == row["g"]]
        assert math.isclose(row["p"], np.quantile(mine, 0.02)) and math.isclose(row["q"], np.quantile(mine, 0.7))
