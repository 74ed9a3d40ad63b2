"""Profiles, summaries and tests."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.views import (
    ORD_NUMERIC, V_DOC, V_EMB, V_EVT, V_ORD, V_RES, documents_view, embeddings_view, events_view,
    orders_view, results_view, rounded, table, u_sql,
)
from tallymark.functions.rng import u
from tallymark.operators import columns, encode, hypothesis, profile, results


@query("value_counts", """
SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS "percent" FROM events GROUP BY 1""")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type").select("event_type", "n", *rounded("percent"))


@query("group_value_counts", f"WITH {V_DOC} SELECT source, lang, count(*) AS n FROM v_doc GROUP BY 1, 2")
def group_value_counts(spark, sf_dir):
    return profile.group_value_counts(documents_view(spark, sf_dir), "source", "lang")


def _long(columns: list[str], fields: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", " + fields.format(c=c) for c in columns)


NULLABLE = ["n_lines", "sum_qty", "sum_price", "avg_disc"]


@query("null_profile", f"""
WITH {V_ORD}
SELECT * FROM ({_long(['o_totalprice', *NULLABLE], 'count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0 / count(*), 6) AS "percent" FROM v_ord')})
WHERE nulls > 0""")
def null_profile(spark, sf_dir):
    return profile.null_profile(orders_view(spark, sf_dir)).select("column", "nulls", *rounded("percent"))


@query("table_info", f"""
WITH {V_ORD}
{_long(['o_orderkey'], "'bigint' AS type, count({c}) AS non_null, count(*) AS \"rows\", 7 AS \"columns\" FROM v_ord")}
UNION ALL {_long(['o_totalprice', *NULLABLE], "'double' AS type, count({c}) AS non_null, count(*) AS \"rows\", 7 AS \"columns\" FROM v_ord")}
UNION ALL {_long(['o_orderstatus'], "'string' AS type, count({c}) AS non_null, count(*) AS \"rows\", 7 AS \"columns\" FROM v_ord")}""")
def table_info(spark, sf_dir):
    return profile.table_info(orders_view(spark, sf_dir).select("o_orderkey", "o_totalprice", *NULLABLE, "o_orderstatus"))


@query("central_tendency", f"""
WITH {V_EVT}
{_long(['value', 'k'], 'round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median, (SELECT CAST({c} AS DOUBLE) FROM v_evt GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode FROM v_evt')}""")
def central_tendency(spark, sf_dir):
    summary = profile.central_tendency(events_view(spark, sf_dir), ["value", "k"])
    return summary.select("column", *rounded("mean", "median"), "mode")


@query("range_summary", f"""
WITH {V_ORD}
{_long(ORD_NUMERIC, 'round(min({c}), 6) AS "min", round(avg({c}), 6) AS mean, round(max({c}), 6) AS "max" FROM v_ord')}""")
def range_summary(spark, sf_dir):
    return profile.range_summary(orders_view(spark, sf_dir), ORD_NUMERIC).select("column", *rounded("min", "mean", "max"))


CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM v_ord" for a in ORD_NUMERIC for b in ORD_NUMERIC
)


@query("corr_matrix", f"WITH {V_ORD}, s AS (SELECT 1) {CORR_SQL}")
def corr_matrix(spark, sf_dir):
    return profile.corr_matrix(orders_view(spark, sf_dir), ORD_NUMERIC).select("a", "b", *rounded("r"))


WELCH_INNER = _long(ORD_NUMERIC, """avg({c}) FILTER (target = 1) AS mean1, avg({c}) FILTER (target = 0) AS mean0,
  var_samp({c}) FILTER (target = 1) / count({c}) FILTER (target = 1) AS e1, count({c}) FILTER (target = 1) AS n1,
  var_samp({c}) FILTER (target = 0) / count({c}) FILTER (target = 0) AS e0, count({c}) FILTER (target = 0) AS n0 FROM v_ord""")
WELCH = f"""{V_ORD}, parts AS ({WELCH_INNER}),
w AS (SELECT "column", mean1, mean0, (mean1 - mean0) / sqrt(e1 + e0) AS t,
             (e1 + e0) * (e1 + e0) / (e1 * e1 / (n1 - 1) + e0 * e0 / (n0 - 1)) AS df FROM parts)"""


@query("welch_ttest", f"""
WITH {WELCH} SELECT "column", round(mean1, 6) AS mean1, round(mean0, 6) AS mean0, round(t, 6) AS t, round(df, 4) AS df FROM w""")
def welch_ttest(spark, sf_dir):
    tests = hypothesis.welch_ttest(orders_view(spark, sf_dir), ORD_NUMERIC, "target")
    return tests.select("column", *rounded("mean1", "mean0", "t"), *rounded("df", digits=4))


# The oracle integrates the t density from 0 to |t| by Simpson's rule with 4,000 steps.
@query("welch_pvalue", f"""
WITH {WELCH}, g AS (SELECT unnest(range(4001)) AS i),
s AS (
  SELECT "column", sum((CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
           * exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi())
                 - (df + 1) / 2 * ln(1 + (abs(t) * i / 4000) * (abs(t) * i / 4000) / df))) * abs(any_value(t)) / 12000 AS half
  FROM w, g GROUP BY 1)
SELECT "column", round(1 - 2 * half, 6) AS p, 1 - 2 * half < 0.05 AS reject FROM s""")
def welch_pvalue(spark, sf_dir):
    tests = hypothesis.welch_ttest(orders_view(spark, sf_dir), ORD_NUMERIC, "target")
    return hypothesis.with_t_pvalue(tests).select("column", *rounded("p"), "reject")


@query("crosstab", f"""
WITH {V_ORD} SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
       count(*) FILTER (o_orderstatus = 'P') AS "P" FROM v_ord GROUP BY 1""")
def crosstab(spark, sf_dir):
    return profile.crosstab(orders_view(spark, sf_dir, lines=False), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


PRIORITIES = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CHI_COLUMNS = [("o_orderpriority", v) for v in PRIORITIES] + [("c_mktsegment", v) for v in SEGMENTS]
CHI_CELLS = " UNION ALL ".join(
    f"""SELECT '{c}_{v}' AS "column", count(*) FILTER ({c} = '{v}' AND target = 1) AS a, count(*) FILTER ({c} = '{v}' AND target = 0) AS b,
    count(*) FILTER ({c} <> '{v}' AND target = 1) AS c, count(*) FILTER ({c} <> '{v}' AND target = 0) AS d FROM v_ord"""
    for c, v in CHI_COLUMNS
)
CHI_YATES = f"""{V_ORD}, cells AS ({CHI_CELLS}),
e AS (SELECT "column", unnest([a, b, c, d]) AS o,
             unnest([(a + b) * (a + c) / (a + b + c + d), (a + b) * (b + d) / (a + b + c + d),
                     (c + d) * (a + c) / (a + b + c + d), (c + d) * (b + d) / (a + b + c + d)]) AS x FROM cells),
y AS (SELECT "column", sum(power(abs(o - x) - least(0.5, abs(o - x)), 2) / x) AS chi2 FROM e GROUP BY 1)"""


@query("chi2_yates", f"""WITH {CHI_YATES} SELECT "column", round(chi2, 6) AS chi2, 1 AS dof FROM y""")
def chi2_yates(spark, sf_dir):
    return _binary_tests(spark, sf_dir).select("column", *rounded("chi2"), "dof")


def _binary_tests(spark, sf_dir):
    orders = orders_view(spark, sf_dir, lines=False).select("o_orderpriority", "c_mktsegment", "target")
    wide = encode.one_hot(orders, ["o_orderpriority", "c_mktsegment"])
    names = columns.feature_names(wide, ["target"])
    return hypothesis.chi2_binary(wide, names, "target")


@query("chi2_general", f"""
WITH {V_ORD}, o AS (SELECT o_orderpriority AS a, o_orderstatus AS b, count(*) AS o FROM v_ord GROUP BY 1, 2),
m AS (SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM o)
SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2, 8 AS dof, CAST(sum(o) AS BIGINT) AS n FROM m""")
def chi2_general(spark, sf_dir):
    return hypothesis.chi2_general(orders_view(spark, sf_dir, lines=False), "o_orderpriority", "o_orderstatus").select(*rounded("chi2"), "dof", "n")


# With one degree of freedom chi is half-normal; the oracle integrates the normal density from 0 to sqrt(chi2).
@query("chi2_pvalue", f"""
WITH {CHI_YATES}, g AS (SELECT unnest(range(4001)) AS i),
s AS (SELECT "column", sum((CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
             * exp(-0.5 * chi2 * (i / 4000.0) * (i / 4000.0))) * sqrt(any_value(chi2)) / 12000 / sqrt(2 * pi()) AS half
      FROM y, g GROUP BY 1)
SELECT "column", round(1 - 2 * half, 6) AS p, 1 - 2 * half < 0.05 AS reject FROM s""")
def chi2_pvalue(spark, sf_dir):
    return hypothesis.with_chi2_pvalue(_binary_tests(spark, sf_dir)).select("column", *rounded("p"), "reject")


ANOVA_PARTS = _long(ORD_NUMERIC, "o_orderstatus AS g, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v FROM v_ord GROUP BY 2")
ANOVA = f"""{V_ORD}, parts AS ({ANOVA_PARTS}),
grand AS (SELECT *, sum(n * m) OVER w / sum(n) OVER w AS gm FROM parts WINDOW w AS (PARTITION BY "column")),
f AS (SELECT "column", (sum(n * (m - gm) * (m - gm)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f
      FROM grand GROUP BY 1)"""


@query("anova_f", f"""WITH {ANOVA} SELECT "column", round(f, 6) AS f FROM f""")
def anova_f(spark, sf_dir):
    return hypothesis.anova_f(orders_view(spark, sf_dir), ORD_NUMERIC, "o_orderstatus").select("column", *rounded("f"))


@query("select_k_best", f"""WITH {ANOVA} SELECT "column", round(f, 6) AS f FROM f ORDER BY f DESC, "column" LIMIT 3""")
def select_k_best(spark, sf_dir):
    best = hypothesis.select_k_best(orders_view(spark, sf_dir), ORD_NUMERIC, "o_orderstatus", k=3)
    return best.select("column", *rounded("f"))


HIST_EDGES = "b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)"
HIST_FIELDS = 'round(lo + bin * (hi - lo) / {n}, 6) AS "left", round(lo + (bin + 1) * (hi - lo) / {n}, 6) AS "right", coalesce(c.n, 0) AS n'


@query("histogram", f"""
WITH {HIST_EDGES}, c AS (SELECT CAST(least(floor((value - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM events, b GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, {HIST_FIELDS.format(n=20)}
FROM (SELECT unnest(range(20)) AS bin) g LEFT JOIN c USING (bin), b""")
def histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "events"), "value", 20).select("bin", *rounded("left", "right"), "n")


@query("histogram_by_class", f"""
WITH {HIST_EDGES}, c AS (SELECT event_type, CAST(least(floor((value - lo) / (hi - lo) * 15), 14) AS INTEGER) AS bin, count(*) AS n FROM events, b GROUP BY 1, 2)
SELECT g.event_type, CAST(g.bin AS INTEGER) AS bin, {HIST_FIELDS.format(n=15)}
FROM (SELECT DISTINCT event_type, unnest(range(15)) AS bin FROM events) g LEFT JOIN c USING (event_type, bin), b""")
def histogram_by_class(spark, sf_dir):
    counts = profile.histogram(table(spark, sf_dir, "events"), "value", 15, by="event_type")
    return counts.select("event_type", "bin", *rounded("left", "right"), "n")


@query("kde_grid", """
WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(value), -0.2) AS h FROM events),
g AS (SELECT i, lo - 3 * h + i * (hi - lo + 6 * h) / 49 AS x, n, h FROM s, (SELECT unnest(range(50)) AS i))
SELECT CAST(i AS INTEGER) AS point, round(x, 6) AS x,
       round(sum(exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM g, events GROUP BY i, x""")
def kde_grid(spark, sf_dir):
    return profile.kde_grid(table(spark, sf_dir, "events"), "value").select("point", *rounded("x", "density"))


@query("box_stats", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
           FROM events GROUP BY 1)
SELECT e.event_type, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       round(any_value(q3 - q1), 6) AS iqr,
       round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS low_whisker,
       round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS high_whisker,
       count(*) FILTER (NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM events e JOIN q ON e.event_type = q.event_type GROUP BY 1""")
def box_stats(spark, sf_dir):
    stats = profile.box_stats(table(spark, sf_dir, "events"), "value", "event_type")
    return stats.select("event_type", *rounded("q1", "median", "q3", "iqr", "low_whisker", "high_whisker"), "outliers")


@query("class_balance", f"""
WITH {V_DOC}
SELECT CASE WHEN {u_sql('doc_id', "'part'")} < 0.3 THEN 'test' ELSE 'train' END AS split, quality, count(*) AS n
FROM v_doc WHERE quality IS NOT NULL GROUP BY 1, 2""")
def class_balance(spark, sf_dir):
    docs = documents_view(spark, sf_dir).filter(F.col("quality").isNotNull())
    split = F.when(u("doc_id", "part") < 0.3, "test").otherwise("train")
    return profile.group_value_counts(docs.withColumn("split", split), "split", "quality")


@query("distinct_values", f"WITH {V_DOC} SELECT DISTINCT lang, quality FROM v_doc")
def distinct_values(spark, sf_dir):
    return profile.distinct_values(documents_view(spark, sf_dir), ["lang", "quality"])


@query("fold_summary", f"""
WITH {V_RES}, s AS (SELECT model, avg(f1) AS m, stddev_pop(f1) AS sd, count(*) AS folds FROM v_res GROUP BY 1)
SELECT model, round(m, 6) AS f1_mean, round(sd, 6) AS f1_std, folds, printf('%.3f±%.3f', round(m, 3), round(sd, 3)) AS f1_text FROM s""")
def fold_summary(spark, sf_dir):
    summary = results.fold_summary(results_view(spark, sf_dir), ["model"], "f1")
    return summary.select("model", *rounded("f1_mean", "f1_std"), "folds", "f1_text")


@query("scenario_summary", f"""
WITH {V_RES}
SELECT scenario, round(avg(f1), 6) AS f1_avg, round(max(f1), 6) AS f1_best, arg_max(model, (f1, -rank)) AS best_model
FROM (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY model) AS rank FROM v_res) GROUP BY 1""")
def scenario_summary(spark, sf_dir):
    return results.scenario_summary(results_view(spark, sf_dir), "scenario", "model", "f1").select(
        "scenario", *rounded("f1_avg", "f1_best"), "best_model"
    )


@query("item_score", f"""
WITH {V_EMB}
SELECT item, round(max(vec[1]), 6) AS score_max, round(avg(vec[1]), 6) AS score_mean FROM v_emb GROUP BY 1""")
def item_score(spark, sf_dir):
    parts = embeddings_view(spark, sf_dir).select("item", F.col("vec")[0].alias("score"))
    highest = profile.item_score(parts, "item", "score").withColumnRenamed("score", "score_max")
    mean = profile.item_score(parts, "item", "score", how="mean").withColumnRenamed("score", "score_mean")
    return highest.join(mean, "item").select("item", *rounded("score_max", "score_mean"))
