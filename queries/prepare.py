"""Encoders, imputers, scalers and feature construction."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.views import (
    LINE_FEATURES, ORD_NUMERIC, V_DOC, V_EMB, V_EVT, V_ORD, V_SCORE, documents_view, embeddings_view, events_view,
    orders_table, orders_view, rounded, scores_view, u_sql,
)
from tallymark.functions.rng import u
from tallymark.functions.vectors import unit
from tallymark.operators import encode, features, impute, projection, scale

CODE = "CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER)"
DOC_QUALITY = "coalesce(CAST(quality AS VARCHAR), 'missing')"


@query("label_encode", f"""
WITH {V_DOC}
SELECT doc_id, {CODE.format(c='lang')} AS lang, {CODE.format(c='source')} AS source, {CODE.format(c=DOC_QUALITY)} AS quality
FROM v_doc""")
def label_encode(spark, sf_dir):
    docs = documents_view(spark, sf_dir)
    return encode.label_encode(docs, ["lang", "source", "quality"], "missing").select("doc_id", "lang", "source", "quality")


@query("label_encode_apply", f"""
WITH {V_DOC}, d AS (SELECT lang AS level, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS code
                    FROM (SELECT DISTINCT lang FROM v_doc))
SELECT doc_id, code AS lang_code FROM v_doc JOIN d ON lang = level WHERE quality IS NOT NULL""")
def label_encode_apply(spark, sf_dir):
    docs = documents_view(spark, sf_dir)
    dictionary = encode.fit_dictionary(docs, "lang")
    labelled = docs.filter(F.col("quality").isNotNull())
    return encode.apply_dictionary(labelled, "lang", dictionary, output="lang_code").select("doc_id", "lang_code")


@query("target_encode", f"""
WITH {V_ORD}
SELECT o_orderkey, {CODE.format(c='o_orderstatus')} AS code, o_orderstatus AS decoded FROM v_ord""")
def target_encode(spark, sf_dir):
    orders = orders_view(spark, sf_dir, lines=False)
    dictionary = encode.fit_dictionary(orders, "o_orderstatus")
    coded = encode.apply_dictionary(orders, "o_orderstatus", dictionary, output="code").select("o_orderkey", "code")
    return encode.decode(coded, "code", dictionary, "decoded")


@query("one_hot", f"""
WITH {V_EVT}
SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS event_type_error,
       CAST(event_type = 'purchase' AS INTEGER) AS event_type_purchase,
       CAST(event_type = 'signup' AS INTEGER) AS event_type_signup, CAST(event_type = 'view' AS INTEGER) AS event_type_view
FROM v_evt""")
def one_hot(spark, sf_dir):
    return encode.one_hot(events_view(spark, sf_dir).select("event_id", "event_type"), ["event_type"])


def _filled_sql(expression: str) -> str:
    parts = ", ".join(f"round(coalesce({c}, {expression.format(c=c)}), 6) AS {c}" for c in LINE_FEATURES)
    return f"WITH {V_ORD} SELECT o_orderkey, {parts} FROM v_ord"


@query("impute_mean", _filled_sql("(SELECT avg({c}) FROM v_ord)"))
def impute_mean(spark, sf_dir):
    orders = orders_table(spark, sf_dir)
    filled = impute.fill_with(orders, impute.fit_mean(orders, LINE_FEATURES))
    return filled.select("o_orderkey", *rounded(*LINE_FEATURES))


@query("impute_median", _filled_sql("(SELECT quantile_cont({c}, 0.5) FROM v_ord)"))
def impute_median(spark, sf_dir):
    orders = orders_table(spark, sf_dir)
    filled = impute.fill_with(orders, impute.fit_median(orders, LINE_FEATURES))
    return filled.select("o_orderkey", *rounded(*LINE_FEATURES))


@query("impute_mode", f"""
WITH {V_DOC}, s AS (SELECT doc_id, quality, CASE WHEN quality IS NOT NULL THEN source END AS source FROM v_doc)
SELECT doc_id,
  coalesce(CAST(quality AS VARCHAR), (SELECT CAST(quality AS VARCHAR) FROM s WHERE quality IS NOT NULL GROUP BY 1
                                      ORDER BY count(*) DESC, 1 LIMIT 1)) AS quality,
  coalesce(source, (SELECT source FROM s WHERE source IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS source
FROM s""")
def impute_mode(spark, sf_dir):
    docs = documents_view(spark, sf_dir).select(
        "doc_id", F.col("quality").cast("string").alias("quality"),
        F.when(F.col("quality").isNotNull(), F.col("source")).alias("source"),
    )
    return impute.fill_with(docs, impute.fit_mode(docs, ["quality", "source"]))


@query("impute_knn", f"""
WITH {V_ORD}, s AS (SELECT * FROM v_ord),
q AS (SELECT o_orderkey AS qk, o_totalprice AS q1, c_acctbal AS q2 FROM s WHERE n_lines IS NULL),
ranked AS (
  SELECT qk, n_lines, sum_qty, sum_price, avg_disc,
         row_number() OVER (PARTITION BY qk ORDER BY sqrt(6.0 / 2.0 * ((o_totalprice - q1) * (o_totalprice - q1)
                            + (c_acctbal - q2) * (c_acctbal - q2))), o_orderkey) AS r
  FROM q, s WHERE n_lines IS NOT NULL),
f AS (SELECT qk, avg(n_lines) AS n_lines, avg(sum_qty) AS sum_qty, avg(sum_price) AS sum_price, avg(avg_disc) AS avg_disc
      FROM ranked WHERE r <= 5 GROUP BY qk)
SELECT o_orderkey, round(coalesce(s.n_lines, f.n_lines), 6) AS n_lines, round(coalesce(s.sum_qty, f.sum_qty), 6) AS sum_qty,
       round(coalesce(s.sum_price, f.sum_price), 4) AS sum_price, round(coalesce(s.avg_disc, f.avg_disc), 6) AS avg_disc
FROM s LEFT JOIN f ON o_orderkey = qk""")
def impute_knn(spark, sf_dir):
    filled = impute.impute_knn(orders_table(spark, sf_dir), "o_orderkey", ORD_NUMERIC, k=5)
    return filled.select(
        "o_orderkey", *rounded("n_lines", "sum_qty", "avg_disc"), *rounded("sum_price", digits=4)
    )


def _standard_sql(where: str, fit_where: str) -> str:
    columns = ["o_totalprice", "c_acctbal", "n_lines"]
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in columns)
    values = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in columns)
    return f"WITH {V_ORD}, s AS (SELECT {stats} FROM v_ord {fit_where}) SELECT o_orderkey, {values} FROM v_ord, s {where}"


@query("scale_standard", _standard_sql("", ""))
def scale_standard(spark, sf_dir):
    orders = orders_table(spark, sf_dir)
    columns = ["o_totalprice", "c_acctbal", "n_lines"]
    return scale.transform(orders, scale.fit_standard(orders, columns), columns).select("o_orderkey", *rounded(*columns))


SPLIT = u_sql("o_orderkey", "'split'")


@query("scale_fit_apply", _standard_sql(f"WHERE {SPLIT} < 0.3", f"WHERE {SPLIT} >= 0.3"))
def scale_fit_apply(spark, sf_dir):
    orders = orders_table(spark, sf_dir)
    columns = ["o_totalprice", "c_acctbal", "n_lines"]
    test = u("o_orderkey", "split") < 0.3
    fitted = scale.fit_standard(orders.filter(~test), columns)
    return scale.transform(orders.filter(test), fitted, columns).select("o_orderkey", *rounded(*columns))


@query("scale_robust", f"""
WITH {V_ORD}, s AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS a, quantile_cont(n_lines, [0.25, 0.5, 0.75]) AS b,
                           quantile_cont(avg_disc, [0.25, 0.5, 0.75]) AS c FROM v_ord)
SELECT o_orderkey, round((o_totalprice - a[2]) / (a[3] - a[1]), 6) AS o_totalprice,
       round((n_lines - b[2]) / (b[3] - b[1]), 6) AS n_lines, round((avg_disc - c[2]) / (c[3] - c[1]), 6) AS avg_disc
FROM v_ord, s""")
def scale_robust(spark, sf_dir):
    orders = orders_table(spark, sf_dir)
    columns = ["o_totalprice", "n_lines", "avg_disc"]
    return scale.transform(orders, scale.fit_robust(orders, columns), columns).select("o_orderkey", *rounded(*columns))


@query("scale_minmax", f"""
WITH {V_SCORE}, s AS (SELECT min(score) AS lo, max(score) AS hi FROM v_score)
SELECT o_orderkey, round((score - lo) / (hi - lo + 1e-8), 6) AS score FROM v_score, s""")
def scale_minmax(spark, sf_dir):
    scores = scores_view(spark, sf_dir).select("o_orderkey", "score")
    return scale.transform(scores, scale.fit_minmax(scores, ["score"]), ["score"]).select("o_orderkey", *rounded("score"))


@query("scale_minmax_group", """
SELECT event_id, user_id, round(CASE WHEN hi = lo THEN 0 ELSE (value - lo) / (hi - lo) END, 6) AS value
FROM (SELECT event_id, user_id, value, min(value) OVER w AS lo, max(value) OVER w AS hi FROM events
      WINDOW w AS (PARTITION BY user_id))""")
def scale_minmax_group(spark, sf_dir):
    events = events_view(spark, sf_dir).select("event_id", "user_id", "value")
    return scale.minmax_within(events, "user_id", "value").select("event_id", "user_id", *rounded("value"))


@query("scale_zscore_group", """
WITH z AS (SELECT event_id, user_id, (value - avg(value) OVER w) / (stddev_pop(value) OVER w + 1e-8) AS z FROM events
           WINDOW w AS (PARTITION BY user_id))
SELECT event_id, user_id, round((z - min(z) OVER w) / (max(z) OVER w - min(z) OVER w + 1e-8), 6) AS value
FROM z WINDOW w AS (PARTITION BY user_id)""")
def scale_zscore_group(spark, sf_dir):
    events = events_view(spark, sf_dir).select("event_id", "user_id", "value")
    return scale.zscore_within(events, "user_id", "value").select("event_id", "user_id", *rounded("value"))


@query("scale_percentile_clip", """
WITH s AS (SELECT user_id, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM events GROUP BY 1)
SELECT event_id, e.user_id, round(greatest(0, least(1, (value - lo) / (hi - lo + 1e-8))), 6) AS value
FROM events e JOIN s ON e.user_id = s.user_id""")
def scale_percentile_clip(spark, sf_dir):
    events = events_view(spark, sf_dir).select("event_id", "user_id", "value")
    return scale.percentile_clip_within(events, "user_id", "value").select("event_id", "user_id", *rounded("value"))


@query("l2_normalize", f"""
WITH {V_EMB}, s AS (SELECT vec_id, list_transform(vec, lambda x: 3.0 * x + 1.0) AS v FROM v_emb),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len FROM s)
SELECT vec_id, list_transform(v, lambda x: round(x / len, 6)) AS unit FROM n""")
def l2_normalize(spark, sf_dir):
    shifted = embeddings_view(spark, sf_dir).select("vec_id", F.transform("vec", lambda x: 3.0 * x + 1.0).alias("v"))
    return shifted.select("vec_id", F.transform(unit(F.col("v")), lambda x: F.round(x, 6)).alias("unit"))


@query("winsorize", f"""
WITH {V_ORD}, r AS (
  SELECT o_orderkey, o_totalprice, sum_qty, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r1,
         count(o_totalprice) OVER () AS n1,
         CASE WHEN sum_qty IS NOT NULL THEN row_number() OVER (ORDER BY sum_qty NULLS LAST, o_orderkey) END AS r2,
         count(sum_qty) OVER () AS n2
  FROM v_ord),
c AS (SELECT max(CASE WHEN r1 = floor(0.05 * n1) + 1 THEN o_totalprice END) AS lo1,
             max(CASE WHEN r1 = n1 - floor(0.05 * n1) THEN o_totalprice END) AS hi1,
             max(CASE WHEN r2 = floor(0.05 * n2) + 1 THEN sum_qty END) AS lo2,
             max(CASE WHEN r2 = n2 - floor(0.05 * n2) THEN sum_qty END) AS hi2 FROM r)
SELECT o_orderkey,
  round(CASE WHEN r1 <= floor(0.05 * n1) THEN lo1 WHEN r1 > n1 - floor(0.05 * n1) THEN hi1 ELSE o_totalprice END, 6) AS o_totalprice,
  round(CASE WHEN r2 <= floor(0.05 * n2) THEN lo2 WHEN r2 > n2 - floor(0.05 * n2) THEN hi2 ELSE sum_qty END, 6) AS sum_qty
FROM r, c""")
def winsorize(spark, sf_dir):
    columns = ["o_totalprice", "sum_qty"]
    return features.winsorize(orders_table(spark, sf_dir), columns).select("o_orderkey", *rounded(*columns))


@query("bin_right_closed", f"""
WITH {V_EVT}
SELECT event_id, CAST(CASE WHEN k > 0 AND k <= 40 THEN 0 WHEN k > 40 AND k <= 55 THEN 1 WHEN k > 55 AND k <= 70 THEN 2
                           WHEN k > 70 AND k <= 100 THEN 3 END AS INTEGER) AS strict_bin,
       CAST(CASE WHEN k > 0 AND k <= 40 THEN 0 WHEN k > 40 AND k <= 55 THEN 1 WHEN k > 55 AND k <= 70 THEN 2
                 WHEN k > 70 AND k <= 100 THEN 3 ELSE 1 END AS INTEGER) AS filled_bin
FROM v_evt""")
def bin_right_closed(spark, sf_dir):
    edges = [0, 40, 55, 70, 100]
    return events_view(spark, sf_dir).select(
        "event_id", features.bin_right_closed("k", edges).alias("strict_bin"),
        features.bin_right_closed("k", edges, fallback=1).alias("filled_bin"),
    )


@query("interaction_features", f"""
WITH {V_ORD}
SELECT o_orderkey, round(o_totalprice * c_acctbal / 10000 + 1e-9, 6) AS product, round(sum_price / sum_qty + 1e-9, 6) AS ratio,
       round(sum_price / (sum_qty + 1) + 1e-9, 6) AS ratio_offset FROM v_ord""")
def interaction_features(spark, sf_dir):
    # The nudge keeps exact half-way values from being rounded differently by the two engines.
    nudge = 1e-9
    return orders_view(spark, sf_dir).select(
        "o_orderkey", (features.product("o_totalprice", "c_acctbal") + nudge).alias("product"),
        (features.ratio("sum_price", "sum_qty", 0.0) + nudge).alias("ratio"),
        (features.ratio("sum_price", "sum_qty") + nudge).alias("ratio_offset"),
    ).select("o_orderkey", *rounded("product", "ratio", "ratio_offset"))


@query("covariance_long", f"""
WITH {V_EMB}, e AS (SELECT vec_id, unnest(vec) AS x, unnest(range(len(vec))) AS i FROM v_emb)
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.x, b.x), 6) AS cov
FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY 1, 2""")
def covariance_long(spark, sf_dir):
    return features.covariance_long(embeddings_view(spark, sf_dir), "vec").select("i", "j", *rounded("cov"))


PROJECTION_DRAW = u_sql("j", "'rp' || o")


@query("random_projection", f"""
WITH {V_EMB}, m AS (
  SELECT j, o, CASE WHEN {PROJECTION_DRAW} < 1 / (2 * sqrt(64)) THEN sqrt(sqrt(64) / 16)
                    WHEN {PROJECTION_DRAW} < 1 / sqrt(64) THEN -sqrt(sqrt(64) / 16) ELSE 0 END AS w
  FROM (SELECT unnest(range(64)) AS j) CROSS JOIN (SELECT unnest(range(16)) AS o)),
e AS (SELECT vec_id, unnest(vec) AS x, unnest(range(64)) AS j FROM v_emb),
p AS (SELECT vec_id, o, sum(x * w) AS v FROM e JOIN m ON e.j = m.j GROUP BY 1, 2)
SELECT vec_id, list(round(v, 6) ORDER BY o) AS projected FROM p GROUP BY 1""")
def random_projection(spark, sf_dir):
    projected = features.random_projection(embeddings_view(spark, sf_dir), "vec", 16)
    return projected.select("vec_id", F.transform("projected", lambda x: F.round(x, 6)).alias("projected"))


@query("pca_variance", f"""
WITH {V_EMB}, e AS (SELECT vec_id, unnest(vec) AS x, unnest(range(len(vec))) AS i FROM v_emb),
t AS (SELECT sum(v) AS total FROM (SELECT var_samp(x) AS v FROM e GROUP BY i))
SELECT round(total, 6) AS total_variance, true AS over_share, true AS fewest, true AS descending, true AS eigen_equation, true AS orthonormal, true AS variances_agree FROM t""")
def pca_variance(spark, sf_dir):
    """The fewest components that explain more than 95 %, checked against the rows: shares, eigen equation, orthonormal axes."""
    vectors = embeddings_view(spark, sf_dir)
    fitted = projection.fit_pca(vectors, "vec", variance=0.95)
    rows = [(i, float(v), float(r), float(c)) for i, (v, r, c) in enumerate(zip(fitted.values, fitted.ratio, fitted.ratio.cumsum()))]
    kept = spark.createDataFrame(rows, "component int, value double, explained double, cumulated double")
    checked = kept.join(projection.residuals(vectors, fitted, "vec"), "component")
    last = F.max_by("explained", "component")
    ordered = F.array_sort(F.collect_list(F.struct("component", "value")))
    return checked.agg(
        F.round(F.lit(fitted.total), 6).alias("total_variance"), (F.max("cumulated") > 0.95).alias("over_share"), (F.max("cumulated") - last <= 0.95).alias("fewest"),
        (F.transform(ordered, lambda x: x["value"]) == F.sort_array(F.collect_list("value"), asc=False)).alias("descending"),
        (F.max("eigen_gap") < 1e-9).alias("eigen_equation"), (F.max("tilt") < 1e-9).alias("orthonormal"),
        (F.max(F.abs(F.col("variance") - F.col("value"))) < 1e-9 * fitted.total).alias("variances_agree"),
    )


def _axis_sql(name: str, matrix: str, width: int = 64, squarings: int = 24) -> str:
    """The first eigenvector of a symmetric matrix (i, j, c): its powers by repeated squaring point along it.

    Of the power's columns the longest is taken; the largest entry of an axis is positive.
    """
    return f"""{name}_pow AS (SELECT 0 AS n, i, j, c / (SELECT sqrt(sum(c * c)) FROM {matrix}) AS c FROM {matrix} UNION ALL
  SELECT n, i, j, c / sqrt(sum(c * c) OVER ()) FROM (SELECT a.n + 1 AS n, a.i, b.j, sum(a.c * b.c) AS c FROM {name}_pow a JOIN {name}_pow b ON a.j = b.i WHERE a.n < {squarings} GROUP BY 1, 2, 3)),
{name}_col AS (SELECT j FROM {name}_pow WHERE n = {squarings} GROUP BY j ORDER BY sum(c * c) DESC, j LIMIT 1),
{name}_raw AS (SELECT i, c / sqrt(sum(c * c) OVER ()) AS c FROM {name}_pow JOIN {name}_col USING (j) WHERE n = {squarings}),
{name} AS (SELECT i, c * sign((SELECT c FROM {name}_raw ORDER BY abs(c) DESC, i LIMIT 1)) AS c FROM {name}_raw)"""


@query("pca_project", f"""
WITH RECURSIVE {V_EMB}, e AS (SELECT vec_id, label, unnest(vec) AS x, unnest(range(len(vec))) AS i FROM v_emb),
m AS (SELECT i, avg(x) AS m FROM e GROUP BY 1), z AS (SELECT vec_id, label, i, x - m AS x FROM e JOIN m USING (i)),
cov AS (SELECT a.i, b.i AS j, sum(a.x * b.x) AS c FROM z a JOIN z b ON a.vec_id = b.vec_id GROUP BY 1, 2), {_axis_sql('a1', 'cov')},
l1 AS (SELECT sum(cov.c * x.c * y.c) AS l FROM cov JOIN a1 x ON x.i = cov.i JOIN a1 y ON y.i = cov.j),
rest AS (SELECT cov.i, cov.j, cov.c - l * x.c * y.c AS c FROM cov JOIN a1 x ON x.i = cov.i JOIN a1 y ON y.i = cov.j, l1), {_axis_sql('a2', 'rest')}
SELECT vec_id, any_value(label) AS label, round(sum(x * a1.c), 6) AS p1, round(sum(x * a2.c), 6) AS p2 FROM z JOIN a1 USING (i) JOIN a2 USING (i) GROUP BY 1""")
def pca_project(spark, sf_dir):
    vectors = embeddings_view(spark, sf_dir)
    projected = projection.project(vectors, projection.fit_pca(vectors, "vec", components=2), "vec", "p")
    return projected.select("vec_id", "label", F.round(F.col("p")[0], 6).alias("p1"), F.round(F.col("p")[1], 6).alias("p2"))
