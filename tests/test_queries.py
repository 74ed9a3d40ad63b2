"""Every registered query against its SQL on the smallest tables, and invariants of those without SQL."""

import pytest
from pyspark.sql import functions as F

from queries import ORACLES, QUERIES
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, data, duck):
    state, detail = compare(QUERIES[name](spark, data), duck, ORACLES[name])
    assert state == "exact", detail


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["clf_logistic", "clf_tree", "clf_forest", "clf_gbt", "clf_svm_rff", "clf_mlp"])
def test_classifier_scores_every_held_out_row(name, spark, data):
    scored = QUERIES[name](spark, data)
    rows = scored.agg(
        F.count("*").alias("n"), F.count_distinct("key").alias("keys"), F.count_if(F.col("score").isNull()).alias("nulls"),
        F.count_if(~F.col("prediction").isin(0, 1)).alias("odd"),
    ).first()
    assert rows["n"] == rows["keys"] > 0 and rows["nulls"] == 0 and rows["odd"] == 0


def test_clusters(spark, data):
    sizes = QUERIES["kmeans_sizes"](spark, data).collect()
    orders = spark.read.parquet(f"{data}/orders.parquet").count()
    assert len(sizes) == 4 and sum(r["n"] for r in sizes) == orders
    assert QUERIES["kmeans_assign"](spark, data).count() == orders
    curve = [r["inertia"] for r in QUERIES["kmeans_elbow"](spark, data).orderBy("k").collect()]
    assert len(curve) == 10 and curve[0] > curve[1] > curve[9] > 0


def test_out_of_fold_predictions_cover_every_row_once(spark, data):
    found = QUERIES["oof_predictions"](spark, data)
    orders = spark.read.parquet(f"{data}/orders.parquet").count()
    assert found.count() == found.select("key").distinct().count() == orders
    sizes = [r["count"] for r in found.groupBy("label", "fold").count().collect()]
    assert len(sizes) == 10


def test_cross_validation_and_searches(spark, data):
    folds = QUERIES["cv_scores"](spark, data).collect()
    assert len(folds) == 9 and all(0 <= r["auc"] <= 1 and 0 <= r["f1"] <= 1 for r in folds)
    assert {r["experiment"] for r in QUERIES["grid_search"](spark, data).collect()} == {1, 2, 3, 4}
    best = QUERIES["search_best"](spark, data).collect()
    assert len(best) == 1 and 1e-12 <= best[0]["var_smoothing"] <= 1e-6


def test_explanations(spark, data):
    weights = QUERIES["importance_select"](spark, data).collect()
    assert abs(sum(r["importance"] for r in weights) - 1) < 1e-4 and any(r["selected"] for r in weights)
    assert len(QUERIES["permutation_importance"](spark, data).collect()) == 6


def test_projections_and_detectors(spark, data):
    shares = [r["cumulated"] for r in QUERIES["pca_variance"](spark, data).orderBy("component").collect()]
    assert shares[-1] > 0.95 and (len(shares) == 1 or shares[-2] <= 0.95)
    vectors = spark.read.parquet(f"{data}/embeddings.parquet").count()
    assert QUERIES["pca_project"](spark, data).count() == vectors
    assert QUERIES["pca_reconstruction_score"](spark, data).filter("score < 0").count() == 0
    assert QUERIES["noise_discriminator"](spark, data).filter("score not between 0 and 1").count() == 0


def test_scenarios(spark, data):
    four = QUERIES["scenario_ablation"](spark, data).collect()
    assert len(four) == 12 and len({r["scenario"] for r in four}) == 4
    six = QUERIES["scenario_folds"](spark, data).collect()
    assert {r["scenario"] for r in six} == {"S0", "S1", "S2", "S3", "S4", "S5"}
    assert all(0 <= r["auc"] <= 1 for r in six)


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
