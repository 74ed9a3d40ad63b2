"""Input views over the given tables, as DataFrames and as SQL text for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.rng import u
from tallymark.functions.vectors import doubles
from tallymark.session import written

ORD_NUMERIC = ["o_totalprice", "c_acctbal", "n_lines", "sum_qty", "sum_price", "avg_disc"]
ORD_FULL = ["o_totalprice", "c_acctbal"]
LINE_FEATURES = ["n_lines", "sum_qty", "sum_price", "avg_disc"]
ORD_CATEGORICAL = ["o_orderpriority", "c_mktsegment"]
DOC_NUMERIC = ["n_chars", "n_words", "n_lines"]
RES_METRICS = ["accuracy", "precision", "recall", "f1"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_view(spark: SparkSession, sf_dir: str, lines: bool = True) -> DataFrame:
    """One row per order with customer and line features; orders without lines have null line features.

    ``lines=False`` leaves the line features out for queries that do not use them.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    features = []
    if lines:
        per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).cast("double").alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_price"),
            F.avg("l_discount").alias("avg_disc"),
        )
        joined = joined.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
        features = ["n_lines", "sum_qty", "sum_price", "avg_disc"]
    return joined.select(
        "o_orderkey", "o_totalprice", "c_acctbal", *features, "o_orderpriority", "c_mktsegment", "o_orderstatus",
        (F.col("o_orderstatus") == "F").cast("int").alias("target"),
    )


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders view written once, for operators that read their input several times."""
    return written(orders_view(spark, sf_dir))


V_ORD = """v_ord AS (
  SELECT o_orderkey, o_totalprice, c_acctbal, n_lines, sum_qty, sum_price, avg_disc, o_orderpriority, c_mktsegment,
         o_orderstatus, CAST(o_orderstatus = 'F' AS INTEGER) AS target
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty,
                    sum(l_extendedprice) AS sum_price, avg(l_discount) AS avg_disc
             FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""


def documents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with size features; ``quality`` is null where no label exists."""
    text = F.col("text")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("double").alias("n_words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("double").alias("n_lines"),
    )
    return documents.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


V_DOC = """v_doc AS (
  SELECT d.doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars,
         CAST(length(text) - length(replace(text, ' ', '')) + 1 AS DOUBLE) AS n_words,
         CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) AS n_lines, quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


V_EVT = """v_evt AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


def embeddings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their item and patch numbers; label 0 is the anomalous class, ``part`` the train / test side."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", doubles("embedding").alias("vec"), "label", (F.col("label") == 0).cast("int").alias("anomalous"),
        F.expr("vec_id div 5").alias("item"), (F.col("vec_id") % 5).cast("int").alias("patch"),
        F.when(u("vec_id", "part") < 0.5, "train").otherwise("test").alias("part"),
    )


def u_sql(key: str, salt: str) -> str:
    """The same hash draw in DuckDB; ``salt`` is a SQL expression."""
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|' || CAST({salt} AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


V_EMB = f"""v_emb AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec, label, CAST(label = 0 AS INTEGER) AS anomalous,
         vec_id // 5 AS item, CAST(vec_id % 5 AS INTEGER) AS patch,
         CASE WHEN {u_sql('vec_id', "'part'")} < 0.5 THEN 'train' ELSE 'test' END AS part
  FROM embeddings)"""


def grid_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One grid per event type: x is the day from the first to the last one, y the hour, v the summed value scaled to 0..255."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    days, first = (last - first).days, F.lit(first)
    cells = events.groupBy(
        F.col("event_type").alias("grid"), F.datediff(F.to_date("ts"), first).alias("x"), F.hour("ts").alias("y"),
    ).agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    dense = (
        events.select(F.col("event_type").alias("grid")).distinct()
        .select("grid", F.explode(F.sequence(F.lit(0), F.lit(days))).alias("x"))
        .select("grid", "x", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("y"))
    )
    full = dense.join(cells, ["grid", "x", "y"], "left").na.fill(0, ["cents"])
    peak = full.groupBy("grid").agg(F.max("cents").alias("peak"))
    return full.join(peak, "grid").select("grid", "x", "y", F.expr("cents * 255 div peak").cast("int").alias("v"))


V_GRID = """v_days AS (SELECT min(CAST(ts AS DATE)) AS first, CAST(date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 AS INTEGER) AS days FROM events),
v_cells AS (
  SELECT event_type AS grid, date_diff('day', first, CAST(ts AS DATE)) AS x, hour(ts) AS y,
         sum(CAST(round(value * 100) AS BIGINT)) AS cents
  FROM events, v_days GROUP BY 1, 2, 3),
v_full AS (
  SELECT g.grid, xs.x, ys.y, coalesce(c.cents, 0) AS cents
  FROM (SELECT DISTINCT event_type AS grid FROM events) g CROSS JOIN (SELECT unnest(range(days)) AS x FROM v_days) xs
  CROSS JOIN (SELECT unnest(range(24)) AS y) ys
  LEFT JOIN v_cells c ON c.grid = g.grid AND c.x = xs.x AND c.y = ys.y),
v_grid AS (
  SELECT grid, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y,
         CAST(cents * 255 // max(cents) OVER (PARTITION BY grid) AS INTEGER) AS v
  FROM v_full)"""


def results_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tidy experiment results: event types as models, calendar weeks as scenarios."""
    value = F.col("value")
    share = lambda cut: F.avg((value > cut).cast("double"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("model"), F.concat(F.lit("W"), F.weekofyear("ts")).alias("scenario"))
        .agg(
            share(20).alias("accuracy"), share(40).alias("precision"), share(60).alias("recall"),
            share(30).alias("f1"), F.stddev_pop((value > 30).cast("double")).alias("f1_std"),
        )
    )


V_RES = """v_res AS (
  SELECT event_type AS model, 'W' || weekofyear(ts) AS scenario, avg(CAST(value > 20 AS DOUBLE)) AS accuracy,
         avg(CAST(value > 40 AS DOUBLE)) AS "precision", avg(CAST(value > 60 AS DOUBLE)) AS recall,
         avg(CAST(value > 30 AS DOUBLE)) AS f1, stddev_pop(CAST(value > 30 AS DOUBLE)) AS f1_std
  FROM events GROUP BY 1, 2)"""


def scores_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored set with many ties: the price as a score, the status as the label."""
    orders = table(spark, sf_dir, "orders")
    peak = orders.agg(F.max("o_totalprice")).first()[0]
    score = F.round(F.col("o_totalprice") / F.lit(peak), 3)
    return orders.select(
        "o_orderkey", "o_orderpriority", score.alias("score"), (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (score >= 0.5).cast("int").alias("prediction"),
    )


V_SCORE = """v_score AS (
  SELECT o_orderkey, o_orderpriority, score, label, CAST(score >= 0.5 AS INTEGER) AS prediction
  FROM (SELECT o_orderkey, o_orderpriority, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
               round(o_totalprice / max(o_totalprice) OVER (), 3) AS score FROM orders))"""


def rounded(*names: str, digits: int = 6):
    return [F.round(F.col(n).cast("double"), digits).alias(n) for n in names]
