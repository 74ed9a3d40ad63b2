"""Metrics, ROC curves, thresholds and comparisons of scored rows."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.views import V_GRID, V_RES, V_SCORE, grid_view, results_view, rounded, scores_view
from tallymark.operators import evaluate, results

CELLS = """count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp"""


@query("confusion_matrix", f"WITH {V_SCORE} SELECT o_orderpriority, {CELLS} FROM v_score GROUP BY 1")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(scores_view(spark, sf_dir), "label", "prediction", ["o_orderpriority"])


@query("binary_metrics", f"""
WITH {V_SCORE}, c AS (SELECT {CELLS} FROM v_score)
SELECT tn, fp, fn, tp, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS "precision",
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM c""")
def binary_metrics(spark, sf_dir):
    metrics = evaluate.binary_metrics(scores_view(spark, sf_dir), "label", "prediction")
    return metrics.select("tn", "fp", "fn", "tp", *rounded("accuracy", "precision", "recall", "f1"))


@query("class_report", f"""
WITH {V_SCORE}, k AS (SELECT DISTINCT unnest([label, prediction]) AS class FROM v_score),
s AS (SELECT class, count(*) FILTER (label = class AND prediction = class) AS tp, count(*) FILTER (label = class) AS support,
             count(*) FILTER (prediction = class) AS predicted FROM k, v_score GROUP BY 1),
p AS (SELECT CAST(class AS VARCHAR) AS class, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS "precision",
             CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, 2 * tp / (support + predicted) AS f1, support FROM s),
a AS (SELECT * FROM p
      UNION ALL SELECT 'macro', avg("precision"), avg(recall), avg(f1), sum(support) FROM p
      UNION ALL SELECT 'weighted', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM p)
SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM a""")
def class_report(spark, sf_dir):
    report = evaluate.class_report(scores_view(spark, sf_dir), "label", "prediction")
    return report.select("class", *rounded("precision", "recall", "f1"), "support")


ROC = f"""{V_SCORE}, g AS (SELECT score AS threshold, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM v_score GROUP BY 1),
roc AS (SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
               CAST(sum(pos) OVER () AS BIGINT) AS positives, CAST(sum(neg) OVER () AS BIGINT) AS negatives
        FROM g WINDOW w AS (ORDER BY threshold DESC))"""


@query("roc_points", f"""
WITH {ROC} SELECT threshold, tp, fp, round(tp / positives, 6) AS tpr, round(fp / negatives, 6) AS fpr FROM roc""")
def roc_points(spark, sf_dir):
    points = evaluate.roc_points(scores_view(spark, sf_dir), "score", "label")
    return points.select("threshold", "tp", "fp", *rounded("tpr", "fpr"))


@query("roc_auc", f"""
WITH {V_SCORE}, g AS (SELECT score, label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM v_score)
SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
             / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) AS auc FROM g""")
def roc_auc(spark, sf_dir):
    return evaluate.roc_auc(scores_view(spark, sf_dir), "score", "label").select(*rounded("auc"))


@query("youden_threshold", f"""
WITH {ROC}
SELECT threshold, round(tp / positives - fp / negatives, 6) AS j FROM roc
ORDER BY CAST(tp AS HUGEINT) * negatives - CAST(fp AS HUGEINT) * positives DESC, threshold DESC LIMIT 1""")
def youden_threshold(spark, sf_dir):
    return evaluate.youden_threshold(scores_view(spark, sf_dir), "score", "label").select("threshold", *rounded("j"))


@query("aupro_approx", f"""
WITH {V_GRID}, c AS (SELECT grid, CAST(grid IN ('error', 'signup') AS INTEGER) AS label,
                            (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER () + 1e-8) AS v FROM v_grid),
t AS (SELECT unnest(range(100)) AS i),
s AS (SELECT i, grid, label, avg(CAST(v > i / 99.0::DOUBLE AS DOUBLE)) AS share FROM c, t GROUP BY 1, 2, 3),
p AS (SELECT i, coalesce(avg(share) FILTER (label = 1), 0) AS hit, 1 - coalesce(avg(share) FILTER (label = 0), 0) AS keep FROM s GROUP BY 1),
b AS (SELECT i, CASE WHEN hit + keep > 0 THEN 2 * hit * keep / (hit + keep + 1e-8) ELSE 0 END AS b FROM p),
a AS (SELECT (b + lead(b) OVER (ORDER BY i)) / 2 / 99 AS a FROM b)
SELECT round(greatest(0, least(1, sum(a))), 6) AS aupro FROM a""")
def aupro_approx(spark, sf_dir):
    cells = grid_view(spark, sf_dir).withColumn("label", F.col("grid").isin("error", "signup").cast("int"))
    return evaluate.aupro_approx(cells, "grid", "v", "label").select(*rounded("aupro"))


@query("compare_models", f"""
WITH {V_SCORE}, m AS (
  SELECT 'half' AS model, label, prediction FROM v_score
  UNION ALL SELECT 'third' AS model, label, CAST(score >= 0.3 AS INTEGER) AS prediction FROM v_score),
c AS (SELECT model, {CELLS} FROM m GROUP BY 1)
SELECT model, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
       CASE WHEN model = 'third' THEN 0.0::DOUBLE ELSE round(tp / (tp + fn), 6) END AS recall FROM c""")
def compare_models(spark, sf_dir):
    scores = scores_view(spark, sf_dir)
    third = scores.withColumn("prediction", (F.col("score") >= 0.3).cast("int"))
    frames = {
        "half": evaluate.binary_metrics(scores, "label", "prediction"),
        "third": evaluate.binary_metrics(third, "label", "prediction").drop("recall"),
    }
    return results.compare_models(frames, ["accuracy", "f1", "recall"]).select("model", *rounded("accuracy", "f1", "recall"))


@query("best_config", f"""
WITH {V_RES}, r AS (SELECT model, scenario, accuracy, f1, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, scenario) AS r FROM v_res)
SELECT model, scenario, round(f1, 6) AS f1, rank() OVER (ORDER BY f1 DESC) AS f1_rank, rank() OVER (ORDER BY accuracy DESC) AS accuracy_rank,
       '{{"model":"' || model || '","base":{{"scenario":"' || scenario || '"}}}}' AS config
FROM r WHERE r = 1""")
def best_config(spark, sf_dir):
    best = results.best_per_group(results_view(spark, sf_dir), ["model"], "f1", ["scenario"])
    ranked = results.metric_ranks(best, ["f1", "accuracy"])
    config = F.to_json(F.struct("model", F.struct("scenario").alias("base")))
    ranks = [F.col(c).cast("bigint").alias(c) for c in ("f1_rank", "accuracy_rank")]
    return ranked.select("model", "scenario", *rounded("f1"), *ranks, config.alias("config"))
