"""Splits, folds, samples and resampling."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.views import (
    DOC_NUMERIC, V_DOC, V_EMB, documents_view, embeddings_view, rounded, table, u_sql,
)
from tallymark.operators import resample, split


@query("split_stratified", f"""
WITH r AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS target FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY {u_sql('o_orderkey', "'split'")}, o_orderkey) AS r,
             count(*) OVER (PARTITION BY target) AS n FROM r)
SELECT o_orderkey, target, r <= floor(n * 0.3 + 0.5) AS is_test FROM n""")
def split_stratified(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("target"))
    return split.stratified_split(orders, "o_orderkey", "target", 0.3)


@query("fold_stratified", f"""
SELECT o_orderkey, o_orderstatus,
       CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {u_sql('o_orderkey', "'fold'")}, o_orderkey) - 1) % 5 AS INTEGER) AS fold,
       CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) % 3 AS INTEGER) AS ordered_fold
FROM orders""")
def fold_stratified(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    shuffled = split.stratified_folds(orders, "o_orderkey", "o_orderstatus", 5)
    ordered = split.stratified_folds(orders, "o_orderkey", "o_orderstatus", 3, shuffle=False)
    return shuffled.join(ordered.select("o_orderkey", F.col("fold").alias("ordered_fold")), "o_orderkey")


SMOTE_DRAW = {s: u_sql("i", f"'{s}'") for s in ("base", "nn", "gap")}
GAP = " ".join(f", round(b.{c} + gap * (o.{c} - b.{c}), 6) AS {c}" for c in DOC_NUMERIC)


@query("smote", f"""
WITH {V_DOC}, real AS (SELECT doc_id, quality, n_chars, n_words, n_lines FROM v_doc WHERE quality IS NOT NULL),
m AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rank FROM real WHERE quality = 0),
c AS (SELECT count(*) FILTER (quality = 0) AS n_min, count(*) FILTER (quality = 1) AS n_max FROM real),
nn AS (SELECT a.doc_id, b.doc_id AS other, row_number() OVER (PARTITION BY a.doc_id ORDER BY
         sqrt((a.n_chars - b.n_chars) * (a.n_chars - b.n_chars) + (a.n_words - b.n_words) * (a.n_words - b.n_words)
              + (a.n_lines - b.n_lines) * (a.n_lines - b.n_lines)), b.doc_id) AS nn
       FROM m a JOIN m b ON a.doc_id <> b.doc_id),
d AS (SELECT i, floor({SMOTE_DRAW['base']} * n_min) + 1 AS rank, floor({SMOTE_DRAW['nn']} * least(5, n_min - 1)) + 1 AS nn,
             {SMOTE_DRAW['gap']} AS gap FROM (SELECT unnest(range((SELECT n_max - n_min FROM c))) AS i), c)
SELECT doc_id, quality, false AS synthetic, n_chars, n_words, n_lines FROM real
UNION ALL
SELECT -1 - i AS doc_id, 0 AS quality, true AS synthetic {GAP}
FROM d JOIN m b ON b.rank = d.rank JOIN nn ON nn.doc_id = b.doc_id AND nn.nn = d.nn JOIN m o ON o.doc_id = nn.other""")
def smote(spark, sf_dir):
    docs = documents_view(spark, sf_dir).filter(F.col("quality").isNotNull())
    vectors = docs.select("doc_id", "quality", F.array(*DOC_NUMERIC).alias("vec"))
    made = resample.smote(vectors, "doc_id", "quality", "vec")
    return made.select(
        "doc_id", "quality", "synthetic", *[F.round(F.col("vec")[i], 6).alias(c) for i, c in enumerate(DOC_NUMERIC)]
    )


@query("sample_n", f"SELECT doc_id, lang, source FROM documents ORDER BY {u_sql('doc_id', chr(39) + 'sample' + chr(39))}, doc_id LIMIT 200")
def sample_n(spark, sf_dir):
    return split.sample_n(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id", 200)


@query("coreset_greedy", f"""
WITH RECURSIVE {V_EMB},
s(round, vec_id, vec, near, chosen, chosen_vec) AS (
  SELECT 0, vec_id, vec, 'inf'::DOUBLE, min(vec_id) OVER (), first_value(vec) OVER (ORDER BY vec_id) FROM v_emb
  UNION ALL
  SELECT round + 1, vec_id, vec, near, first_value(vec_id) OVER (ORDER BY near DESC, vec_id), first_value(vec) OVER (ORDER BY near DESC, vec_id)
  FROM (SELECT round, vec_id, vec, CASE WHEN vec_id = chosen THEN -1 ELSE least(near,
          sqrt(list_sum(list_transform(list_zip(vec, chosen_vec), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))) END AS near FROM s WHERE round < 11))
SELECT vec_id, CAST(round AS INTEGER) AS round, CASE WHEN round > 0 THEN round(near, 6) END AS gap FROM s WHERE vec_id = chosen""")
def coreset_greedy(spark, sf_dir):
    chosen = resample.coreset_greedy(embeddings_view(spark, sf_dir), "vec_id", "vec", 12)
    return chosen.select("vec_id", "round", *rounded("gap"))


NOISE = f"sqrt(-2 * ln(1 - {u_sql('cell', chr(39) + 'n1' + chr(39))})) * cos(2 * pi() * {u_sql('cell', chr(39) + 'n2' + chr(39))})"


@query("noise_thirds", f"""
WITH {V_EMB}, r AS (SELECT vec_id, vec, row_number() OVER (ORDER BY vec_id) - 1 AS r, count(*) OVER () // 3 AS size FROM v_emb),
s AS (SELECT vec_id, vec, 0.015 * CASE least(r // size, 2) WHEN 0 THEN 0.5 WHEN 1 THEN 1.0 ELSE 2.0 END AS sd FROM r),
e AS (SELECT vec_id, sd, unnest(vec) AS x, unnest(range(len(vec))) AS i FROM s),
c AS (SELECT *, vec_id || '_' || i AS cell FROM e)
SELECT vec_id, list(round(x + sd * {NOISE}, 6) ORDER BY i) AS noised FROM c GROUP BY vec_id""")
def noise_thirds(spark, sf_dir):
    shaken = resample.noised(embeddings_view(spark, sf_dir), "vec_id", "vec", 0.015)
    return shaken.select("vec_id", F.transform("noised", lambda x: F.round(x, 6)).alias("noised"))


@query("class_weights", f"""
WITH {V_DOC}, l AS (SELECT doc_id, quality FROM v_doc WHERE quality IS NOT NULL)
SELECT doc_id, quality, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM l""")
def class_weights(spark, sf_dir):
    docs = documents_view(spark, sf_dir).filter(F.col("quality").isNotNull()).select("doc_id", "quality")
    return split.class_weight(docs, "quality").select("doc_id", "quality", *rounded("weight"))
