"""Result tables: ranking, reshaping, text forms, and scalar, array and configuration functions."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.statistics import WELCH
from queries.views import (
    ORD_NUMERIC, RES_METRICS, V_EMB, V_EVT, V_RES, V_SCORE, embeddings_view, events_view, orders_view, results_view, rounded,
    scores_view,
)
from tallymark.functions import vectors
from tallymark.functions.rng import pick_float
from tallymark.operators import hypothesis, results


@query("best_per_group", f"""
WITH {V_RES}, r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, scenario) AS r FROM v_res)
SELECT model, scenario, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy FROM r WHERE r = 1""")
def best_per_group(spark, sf_dir):
    best = results.best_per_group(results_view(spark, sf_dir), ["model"], "f1", ["scenario"])
    return best.select("model", "scenario", *rounded("f1", "accuracy"))


@query("best_worst", f"""
WITH {V_RES}, r AS (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY f1 DESC, model) AS hi,
                           row_number() OVER (PARTITION BY scenario ORDER BY f1, model) AS lo FROM v_res)
SELECT scenario, max(CASE WHEN hi = 1 THEN model END) AS best, max(CASE WHEN lo = 1 THEN model END) AS worst FROM r GROUP BY 1""")
def best_worst(spark, sf_dir):
    return results.best_and_worst(results_view(spark, sf_dir), ["scenario"], "f1", "model")


@query("importance_topk", f"""
WITH {WELCH}, r AS (SELECT "column", abs(t) AS importance, row_number() OVER (ORDER BY abs(t) DESC, "column") AS "rank" FROM w)
SELECT "column", round(importance, 6) AS importance, CAST("rank" AS INTEGER) AS "rank" FROM r WHERE "rank" <= 4""")
def importance_topk(spark, sf_dir):
    tests = hypothesis.welch_ttest(orders_view(spark, sf_dir), ORD_NUMERIC, "target")
    top = results.ranked_top(tests.withColumn("importance", F.abs("t")), "importance", ["column"], 4)
    return top.select("column", *rounded("importance"), "rank")


@query("topk_results", f"""
WITH {V_SCORE} SELECT o_orderkey, score, label FROM v_score ORDER BY score DESC, o_orderkey LIMIT 20""")
def topk_results(spark, sf_dir):
    return results.top_rows(scores_view(spark, sf_dir), "score", ["o_orderkey"], 20).select("o_orderkey", "score", "label")


@query("custom_order", f"""
WITH {V_RES} SELECT model, scenario, round(f1, 6) AS f1, CAST(list_position(['view', 'click', 'purchase'], model) AS INTEGER) AS position
FROM v_res WHERE model IN ('view', 'click', 'purchase')""")
def custom_order(spark, sf_dir):
    ordered = results.in_label_order(results_view(spark, sf_dir), "model", ["view", "click", "purchase", "refund"])
    return ordered.select("model", "scenario", *rounded("f1"), "position")


@query("scenario_union", f"""
WITH {V_RES}
SELECT model, round(f1, 6) AS f1, round(recall, 6) AS recall, 'first' AS origin FROM v_res WHERE scenario = 'W1'
UNION ALL SELECT model, round(f1, 6), NULL, 'second' FROM v_res WHERE scenario = 'W2'""")
def scenario_union(spark, sf_dir):
    tidy = results_view(spark, sf_dir)
    first = tidy.filter("scenario = 'W1'").select("model", "f1", "recall", F.lit("first").alias("origin"))
    second = tidy.filter("scenario = 'W2'").select("model", "f1", F.lit("second").alias("origin"))
    return results.append([first, second]).select("model", *rounded("f1", "recall"), "origin")


@query("metrics_melt", f"""
WITH {V_RES}, l AS (
  UNPIVOT (SELECT model, scenario, accuracy, "precision", recall, f1 FROM v_res) ON accuracy, "precision", recall, f1 INTO NAME metric VALUE score)
SELECT model, scenario, metric, round(score, 6) AS score FROM l""")
def metrics_melt(spark, sf_dir):
    tidy = results_view(spark, sf_dir).select("model", "scenario", *RES_METRICS)
    return results.melt(tidy, ["model", "scenario"], RES_METRICS).select("model", "scenario", "metric", *rounded("score"))


WEEKS = ["W1", "W2", "W3", "W4", "W5"]
PIVOTED = ", ".join(f"round(max(f1) FILTER (scenario = '{w}'), 6) AS {w}" for w in WEEKS)


@query("metrics_pivot", f"WITH {V_RES} SELECT model, {PIVOTED} FROM v_res GROUP BY 1")
def metrics_pivot(spark, sf_dir):
    return results.pivot_metric(results_view(spark, sf_dir), "model", "scenario", WEEKS, "f1").select("model", *rounded(*WEEKS))


@query("config_flatten", f"""
WITH {V_RES}
SELECT model, scenario, 'set_' || scenario AS dataset, '256x256' AS image_size, round(f1, 6) AS f1_score,
       CASE WHEN model = 'click' THEN 5 END AS k_neighbors, CASE WHEN model = 'view' THEN 0.015::DOUBLE END AS noise_std,
       CASE WHEN model = 'view' THEN 50 WHEN model = 'error' THEN 100 END AS epochs FROM v_res""")
def config_flatten(spark, sf_dir):
    config = F.struct(
        F.struct(F.concat(F.lit("set_"), "scenario").alias("dataset"), F.array(F.lit(256), F.lit(256)).alias("size")).alias("base"),
        F.struct(F.lit(5).alias("neighbors")).alias("bank"), F.struct(F.lit(0.015).alias("std"), F.lit(50).alias("epochs")).alias("noise"),
        F.struct(F.lit(100).alias("epochs")).alias("code"),
    )
    records = results_view(spark, sf_dir).withColumn("config", config)
    own = {
        "click": {"k_neighbors": "bank.neighbors"},
        "view": {"noise_std": "noise.std", "epochs": "noise.epochs"},
        "error": {"epochs": "code.epochs"},
    }
    flat = results.flatten_config(records, "model", "config", {"dataset": "base.dataset", "size": "base.size"}, own)
    return flat.select(
        "model", "scenario", "dataset", F.array_join(F.col("size").cast("array<string>"), "x").alias("image_size"),
        F.round("f1", 6).alias("f1_score"), "k_neighbors", "noise_std", "epochs",
    )


@query("metric_text", f"""
WITH {V_RES}, t AS (SELECT model, scenario, printf('%.3f±%.3f', round(f1, 3), round(f1_std, 3)) AS text FROM v_res)
SELECT model, scenario, text, CAST(string_split(text, '±')[1] AS DOUBLE) AS mean, CAST(string_split(text, '±')[2] AS DOUBLE) AS std,
       upper(replace(model, 'click', 'c k')) AS title, 'best_' || lower(model) AS slug,
       regexp_replace(string_split('runs/' || model || '/' || scenario || '.csv', '/')[-1], '\\.[^.]*$', '') AS stem FROM t""")
def metric_text(spark, sf_dir):
    text = results.plus_minus(F.col("f1"), F.col("f1_std"))
    mean, std = results.parse_plus_minus(F.col("text"))
    path = F.concat(F.lit("runs/"), "model", F.lit("/"), "scenario", F.lit(".csv"))
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    return results_view(spark, sf_dir).withColumn("text", text).select(
        "model", "scenario", "text", mean.alias("mean"), std.alias("std"),
        F.upper(F.replace("model", F.lit("click"), F.lit("c k"))).alias("title"),
        F.concat(F.lit("best_"), F.lower("model")).alias("slug"), stem.alias("stem"),
    )


@query("math_scalar", f"""
WITH {V_EVT}
SELECT event_id, greatest(0, least(100, value)) AS clipped, round(pow(value / 100, 1 / 1.5::DOUBLE), 6) AS powered,
       round(exp(-value / 50), 6) AS decayed, round(sqrt(value), 6) AS rooted, round(exp(ln(0.01) + k / 100.0::DOUBLE * (ln(10) - ln(0.01))), 6) AS log_uniform,
       CAST(floor(value / 7) AS BIGINT) AS floored FROM v_evt""")
def math_scalar(spark, sf_dir):
    v = F.col("value")
    return events_view(spark, sf_dir).select(
        "event_id", F.greatest(F.lit(0.0), F.least(F.lit(100.0), v)).alias("clipped"),
        F.round(F.pow(v / 100, F.lit(1 / 1.5)), 6).alias("powered"), F.round(F.exp(-v / 50), 6).alias("decayed"),
        F.round(F.sqrt(v), 6).alias("rooted"), F.round(pick_float(F.col("k") / 100.0, 0.01, 10.0, log=True), 6).alias("log_uniform"),
        F.floor(v / 7).alias("floored"),
    )


@query("array_ops", f"""
WITH {V_EMB}, n AS (SELECT vec_id, vec, list_reverse(vec) AS rev FROM v_emb)
SELECT vec_id, round(sqrt(list_sum(list_transform(vec, lambda x: x * x))), 6) AS length,
       round(list_sum(list_transform(list_zip(vec, rev), lambda x: abs(x[1] - x[2]))), 6) AS gap, round(list_avg(vec), 6) AS mean,
       round(list_max(vec), 6) AS top, len(list_concat(vec, rev)) AS joined FROM n""")
def array_ops(spark, sf_dir):
    vec, rev = F.col("vec"), F.reverse("vec")
    gap = vectors.total(F.transform(vectors.minus(vec, rev), F.abs))
    return embeddings_view(spark, sf_dir).select(
        "vec_id", vectors.norm(vec).alias("length"), gap.alias("gap"), vectors.mean_of(vec).alias("mean"),
        F.array_max(vec).alias("top"), F.size(F.flatten(F.array(vec, rev))).cast("bigint").alias("joined"),
    ).select("vec_id", *rounded("length", "gap", "mean", "top"), "joined")
