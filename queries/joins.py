"""Neighbour joins, parameter grids and joins of result tables."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.views import (
    V_EMB, V_ORD, V_RES, embeddings_view, orders_table, orders_view, results_view, rounded, table,
)
from tallymark.operators import neighbours, results
from tallymark.session import written

KNN = """
WITH {v}, d AS (
  SELECT a.vec_id AS left_key, b.vec_id AS right_key, {distance} AS distance
  FROM v_emb a JOIN v_emb b ON a.part = 'test' AND b.part = 'train'),
r AS (SELECT *, row_number() OVER (PARTITION BY left_key ORDER BY distance, right_key) AS "rank" FROM d)
SELECT left_key, right_key, round(distance, 6) AS distance, CAST("rank" AS INTEGER) AS "rank" FROM r WHERE "rank" <= 5"""
L2 = "sqrt(list_sum(list_transform(list_zip(a.vec, b.vec), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))"
L1 = "list_sum(list_transform(list_zip(a.vec, b.vec), lambda x: abs(x[1] - x[2])))"
L3 = "pow(list_sum(list_transform(list_zip(a.vec, b.vec), lambda x: pow(abs(x[1] - x[2]), 3))), 1.0 / 3)"


def _knn(spark, sf_dir, p):
    vectors = embeddings_view(spark, sf_dir)
    test, train = vectors.filter("part = 'test'"), vectors.filter("part = 'train'")
    pairs = neighbours.knn_join(test, train, 5, "vec_id", "vec_id", p=p)
    return pairs.select("left_key", "right_key", *rounded("distance"), "rank")


@query("knn_join_l2", KNN.format(v=V_EMB, distance=L2))
def knn_join_l2(spark, sf_dir):
    return _knn(spark, sf_dir, 2)


@query("knn_join_l1", KNN.format(v=V_EMB, distance=L1))
def knn_join_l1(spark, sf_dir):
    return _knn(spark, sf_dir, 1)


@query("knn_join_lp", KNN.format(v=V_EMB, distance=L3))
def knn_join_lp(spark, sf_dir):
    return _knn(spark, sf_dir, 3)


SCALED = """o AS (SELECT o_orderkey, o_totalprice / 1000 AS a, c_acctbal / 100 AS b, n_lines FROM v_ord)"""


@query("knn_join_pivots", f"""
WITH {V_ORD}, {SCALED},
r AS (SELECT l.o_orderkey AS left_key, r.o_orderkey AS right_key, sqrt((l.a - r.a) * (l.a - r.a) + (l.b - r.b) * (l.b - r.b)) AS distance
      FROM o l JOIN o r ON l.n_lines IS NULL AND r.n_lines IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY left_key ORDER BY distance, right_key) AS "rank" FROM r)
SELECT left_key, right_key, round(distance, 6) AS distance, CAST("rank" AS INTEGER) AS "rank" FROM k WHERE "rank" <= 5""")
def knn_join_pivots(spark, sf_dir):
    """The orders with lines that are nearest to each order without, comparing only pairs within reach."""
    orders = orders_table(spark, sf_dir).select(
        "o_orderkey", "n_lines", F.array(F.col("o_totalprice") / 1000, F.col("c_acctbal") / 100).alias("vec")
    )
    pairs = neighbours.knn_join(
        orders.filter("n_lines is null"), orders.filter("n_lines is not null"), 5, "o_orderkey", "o_orderkey", pivots=64
    )
    return pairs.select("left_key", "right_key", *rounded("distance"), "rank")


@query("param_grid", f"""
WITH {V_ORD},
p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i FROM (SELECT DISTINCT o_orderpriority FROM v_ord)),
s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS j FROM (SELECT DISTINCT c_mktsegment FROM v_ord)),
t AS (SELECT target, row_number() OVER (ORDER BY target) - 1 AS k FROM (SELECT DISTINCT target FROM v_ord)),
n AS (SELECT o_orderpriority, c_mktsegment, target, count(*) AS n FROM v_ord GROUP BY 1, 2, 3)
SELECT CAST((i * (SELECT count(*) FROM s) + j) * (SELECT count(*) FROM t) + k + 1 AS INTEGER) AS experiment,
       p.o_orderpriority, s.c_mktsegment, t.target, coalesce(n.n, 0) AS n
FROM p CROSS JOIN s CROSS JOIN t LEFT JOIN n ON n.o_orderpriority = p.o_orderpriority AND n.c_mktsegment = s.c_mktsegment
     AND n.target = t.target""")
def param_grid(spark, sf_dir):
    """All combinations of the category values found in the orders, with the number of orders in each."""
    orders = orders_view(spark, sf_dir, lines=False)
    names = ["o_orderpriority", "c_mktsegment", "target"]
    found = orders.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in names]).first()
    grid = results.param_grid(spark, {c: found[c] for c in names})
    counts = orders.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, names, "left").na.fill(0, ["n"]).select("experiment", *names, "n")


@query("baseline_uplift", f"""
WITH {V_RES}, s AS (SELECT scenario, avg(f1) AS f1, avg(accuracy) AS accuracy FROM v_res GROUP BY 1),
b AS (SELECT f1 AS bf, accuracy AS ba FROM s WHERE scenario = 'W1')
SELECT scenario, round((f1 - bf) / bf * 100, 6) AS f1_uplift, round((accuracy - ba) / ba * 100, 6) AS accuracy_uplift FROM s, b""")
def baseline_uplift(spark, sf_dir):
    scenarios = results_view(spark, sf_dir).groupBy("scenario").agg(F.avg("f1").alias("f1"), F.avg("accuracy").alias("accuracy"))
    compared = results.uplift(scenarios, ["f1", "accuracy"], F.col("scenario") == "W1")
    return compared.select("scenario", *rounded("f1_uplift", "accuracy_uplift"))


# One cell is left out here, so that the matrix has an absent pair to show.
@query("model_scenario_matrix", f"""
WITH {V_RES}, v_part AS (SELECT * FROM v_res WHERE NOT (model = 'error' AND scenario = 'W3'))
SELECT m.model, s.scenario, round(f1, 6) AS f1 FROM (SELECT DISTINCT model FROM v_part) m CROSS JOIN (SELECT DISTINCT scenario FROM v_part) s
LEFT JOIN v_part r ON r.model = m.model AND r.scenario = s.scenario""")
def model_scenario_matrix(spark, sf_dir):
    tidy = results_view(spark, sf_dir).filter("not (model = 'error' and scenario = 'W3')")
    levels = tidy.agg(F.collect_set("scenario")).first()[0]
    return results.full_matrix(tidy, "model", "scenario", ["f1"], levels).select("model", "scenario", *rounded("f1"))


@query("unlabelled_anti", "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlabelled_anti(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("knn_join_lsh", f"""
WITH {V_EMB} SELECT count(*) FILTER (part = 'test') AS left_rows, 5 * count(*) FILTER (part = 'test') AS pairs, true AS found_nine_tenths,
  true AS distances_exact FROM v_emb""")
def knn_join_lsh(spark, sf_dir):
    """The approximate join of all test vectors, held against the exact one: are 0.9 of the true neighbours found?"""
    vectors = written(embeddings_view(spark, sf_dir))
    test, train = vectors.filter("part = 'test'"), vectors.filter("part = 'train'")
    about = neighbours.knn_join_lsh(test, train, 5, "vec_id", "vec_id").withColumnRenamed("distance", "about")
    exact = neighbours.knn_join(test, train, 5, "vec_id", "vec_id").drop("rank")
    both = about.join(exact, ["left_key", "right_key"], "full")
    found = F.count("about")
    return both.agg(
        F.count_distinct("left_key").alias("left_rows"), found.alias("pairs"),
        (F.count_if(F.col("about").isNotNull() & F.col("distance").isNotNull()) >= 0.9 * F.count("distance")).alias("found_nine_tenths"),
        F.bool_and(F.coalesce(F.abs(F.col("about") - F.col("distance")) < 1e-9, F.lit(True))).alias("distances_exact"),
    )
