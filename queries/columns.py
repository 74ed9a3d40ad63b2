"""Projections, filters and recoding."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.views import (
    ORD_CATEGORICAL, V_DOC, V_EVT, V_ORD, V_SCORE, documents_view, events_view, orders_view, scores_view, table,
)
from tallymark.operators import columns


@query("filter_eq", "SELECT event_id, user_id, CAST(value AS DOUBLE) AS value FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf_dir):
    events = columns.filter_equal(table(spark, sf_dir, "events"), "event_type", "purchase")
    return columns.filter_equal(events, "no_such_column", 1).select("event_id", "user_id", "value")


@query("drop_cols", """
SELECT o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def drop_cols(spark, sf_dir):
    return table(spark, sf_dir, "orders").drop("o_orderkey", "o_custkey", "o_orderdate", "id")


@query("feature_target", f"""
WITH {V_ORD} SELECT o_totalprice, c_acctbal, n_lines, round(sum_qty, 6) AS sum_qty, target AS label FROM v_ord""")
def feature_target(spark, sf_dir):
    excluded = ["o_orderkey", "o_orderstatus", "sum_price", "avg_disc", *ORD_CATEGORICAL]
    frame, _ = columns.features_and_target(orders_view(spark, sf_dir), "target", excluded)
    return frame.withColumn("sum_qty", F.round("sum_qty", 6))


@query("binarize_target", """
SELECT vec_id, label, CAST(label > 0 AS INTEGER) AS target FROM embeddings""")
def binarize_target(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", columns.binarize("label").alias("target"))


@query("bool_to_int", """
SELECT event_id, CAST(value > 50 AS INTEGER) AS high, CAST(event_type = 'error' AS INTEGER) AS failed FROM events""")
def bool_to_int(spark, sf_dir):
    flags = table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") > 50).alias("high"), (F.col("event_type") == "error").alias("failed")
    )
    return flags.select("event_id", *[F.col(c).cast("int").alias(c) for c in columns.categorical_columns(flags)])


@query("select_numeric", f"""
WITH {V_EVT} SELECT user_id, value, k FROM v_evt""")
def select_numeric(spark, sf_dir):
    events = events_view(spark, sf_dir)
    return events.select(*columns.numeric_columns(events, excluded=["event_id"]))


@query("column_roles", f"""
WITH {V_DOC}
SELECT column_name AS "column",
       CASE column_name WHEN 'doc_id' THEN 'ignored' WHEN 'quality' THEN 'target' WHEN 'lang' THEN 'categorical'
                        WHEN 'source' THEN 'categorical' ELSE 'numeric' END AS role,
       CASE column_name WHEN 'doc_id' THEN 'bigint' WHEN 'quality' THEN 'int' WHEN 'lang' THEN 'string'
                        WHEN 'source' THEN 'string' ELSE 'double' END AS "type",
       non_null
FROM (SELECT count(doc_id) AS doc_id, count(lang) AS lang, count(source) AS source, count(n_chars) AS n_chars,
             count(n_words) AS n_words, count(n_lines) AS n_lines, count(quality) AS quality FROM v_doc)
UNPIVOT (non_null FOR column_name IN (doc_id, lang, source, n_chars, n_words, n_lines, quality))""")
def column_roles(spark, sf_dir):
    docs = documents_view(spark, sf_dir)
    roles = columns.column_roles(docs, ["lang", "source"], "quality", excluded=["doc_id"])
    counts = docs.agg(*[F.count(c).alias(c) for c in docs.columns])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(role).alias("role"), F.lit(kind).alias("type"), F.col(c).alias("non_null"))
        for c, role, kind in roles
    ]
    return counts.select(F.inline(F.array(*entries)))


@query("threshold_predict", f"""
WITH {V_SCORE}
SELECT o_orderkey, score, CAST(score >= 0.3 AS INTEGER) AS at_least, CAST(score > 0.5 AS INTEGER) AS above FROM v_score""")
def threshold_predict(spark, sf_dir):
    return scores_view(spark, sf_dir).select(
        "o_orderkey", "score", columns.predict_at("score", 0.3).alias("at_least"),
        columns.predict_at("score", 0.5, strict=True).alias("above"),
    )
