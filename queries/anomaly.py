"""Anomaly scoring of vectors."""

from pyspark.sql import functions as F

from queries.joins import L2
from queries.registry import query
from queries.views import V_EMB, V_SCORE, embeddings_view, rounded, scores_view, u_sql
from tallymark.functions.rng import u
from tallymark.operators import anomaly, evaluate, projection

BANK = f"""{V_EMB}, d AS (
  SELECT a.vec_id, a.item, a.anomalous, b.vec_id AS other, {L2} AS distance
  FROM v_emb a JOIN v_emb b ON a.part = 'test' AND b.part = 'train' AND b.anomalous = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, other) AS r FROM d),
bank AS (SELECT vec_id, item, any_value(anomalous) AS anomalous, avg(distance) AS score FROM r WHERE r <= 5 GROUP BY 1, 2)"""


def _sides(spark, sf_dir):
    vectors = embeddings_view(spark, sf_dir)
    return vectors.filter("part = 'train' and anomalous = 0"), vectors.filter("part = 'test'")


@query("memory_bank_score", f"WITH {BANK} SELECT vec_id, round(score, 6) AS score FROM bank")
def memory_bank_score(spark, sf_dir):
    bank, test = _sides(spark, sf_dir)
    return anomaly.memory_bank_score(test, bank, "vec_id", "vec", 5).select("vec_id", *rounded("score"))


@query("patch_max_score", f"""
WITH {BANK} SELECT item, vec_id, round(score, 6) AS score, round(max(score) OVER (PARTITION BY item), 6) AS item_score FROM bank""")
def patch_max_score(spark, sf_dir):
    bank, test = _sides(spark, sf_dir)
    scores = anomaly.memory_bank_score(test, bank, "vec_id", "vec", 5)
    return anomaly.patch_scores(scores, test, "vec_id", "item").select("item", "vec_id", *rounded("score", "item_score"))


@query("pca_reconstruction_score")
def pca_reconstruction_score(spark, sf_dir):
    bank, test = _sides(spark, sf_dir)
    fitted = projection.fit_pca(bank, "vec", components=16)
    return projection.reconstruction_error(test, fitted, "vec", "score").select("vec_id", "anomalous", *rounded("score"))


@query("noise_discriminator")
def noise_discriminator(spark, sf_dir):
    normal, test = _sides(spark, sf_dir)
    scores = anomaly.noise_discriminator(normal, test, "vec_id", "vec", 0.05)
    return scores.join(test.select("vec_id", "item"), "vec_id").groupBy("item").agg(F.max("score").alias("score"))


@query("score_fusion", f"""
WITH {V_EMB} SELECT vec_id, round(0.5 * list_max(vec) + 0.5 * list_avg(vec), 6) AS score FROM v_emb""")
def score_fusion(spark, sf_dir):
    vectors = embeddings_view(spark, sf_dir)
    mean = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x) / F.size("vec")
    fused = anomaly.fuse(
        vectors.select("vec_id", F.array_max("vec").alias("score")), vectors.select("vec_id", mean.alias("score")), "vec_id"
    )
    return fused.select("vec_id", *rounded("score"))


TUNE = u_sql("o_orderkey", "'tune'")


@query("anomaly_eval", f"""
WITH {V_SCORE}, k AS (SELECT *, {TUNE} < 0.5 AS tune FROM v_score),
e AS (SELECT min(score) AS lo, max(score) AS hi FROM k WHERE tune),
s AS (SELECT label, tune, (score - lo) / (hi - lo + 1e-8) AS score FROM k, e),
g AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM s WHERE tune GROUP BY 1),
roc AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM g WINDOW w AS (ORDER BY score DESC)),
t AS (SELECT score AS threshold FROM roc ORDER BY tp * n - fp * p DESC, score DESC LIMIT 1),
c AS (SELECT any_value(threshold) AS threshold, count(*) FILTER (label = 0 AND score < threshold) AS tn,
             count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 1 AND score < threshold) AS fn,
             count(*) FILTER (label = 1 AND score >= threshold) AS tp FROM s, t WHERE NOT tune),
a AS (SELECT (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
             / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc
      FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s WHERE NOT tune))
SELECT tn, fp, fn, tp, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
       round(threshold, 6) AS threshold, round(auc, 6) AS auc FROM c, a""")
def anomaly_eval(spark, sf_dir):
    scores = scores_view(spark, sf_dir)
    tune = u("o_orderkey", "tune") < 0.5
    result = anomaly.evaluate_scores(scores.filter(tune), scores.filter(~tune), "score", "label")
    return result.select("tn", "fp", "fn", "tp", *rounded("accuracy", "f1", "threshold", "auc"))


@query("focal_loss", f"""
WITH {V_SCORE}, p AS (SELECT o_orderkey, CASE WHEN label = 1 THEN p ELSE 1 - p END AS pt
                      FROM (SELECT o_orderkey, label, 0.05 + 0.9 * score AS p FROM v_score))
SELECT o_orderkey, round(0.25 * pow(1 - pt, 2) * -ln(pt), 6) AS loss FROM p""")
def focal_loss(spark, sf_dir):
    probability = 0.05 + 0.9 * F.col("score")
    return scores_view(spark, sf_dir).select(
        "o_orderkey", F.round(evaluate.focal_loss(probability, F.col("label")), 6).alias("loss")
    )
