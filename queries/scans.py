"""Scans, catalogues and sinks."""

from pyspark.sql import functions as F

from queries.registry import query
from queries.views import V_DOC, V_ORD, V_RES, documents_view, orders_view, results_view, rounded, table
from tallymark.operators import scale
from tallymark.session import scratch_path
from tallymark.sources import files, tables


@query("scan_project", """
SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
WHERE o_totalprice > 200000 AND o_orderstatus = 'F'""")
def scan_project(spark, sf_dir):
    orders = tables.read_table(spark, f"{sf_dir}/orders.parquet")
    return orders.filter((F.col("o_totalprice") > 200000) & (F.col("o_orderstatus") == "F")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


BARE = r"regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '')"


@query("path_catalog", f"""
SELECT page_id, url AS path, p[-3] AS "type", p[-2] AS label, p[-1] AS filename
FROM (SELECT page_id, url, string_split({BARE}, '/') AS p FROM pages)""")
def path_catalog(spark, sf_dir):
    return files.catalog(table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path")))


@query("path_count", f"""
SELECT regexp_replace(bare, '/[^/]*$', '') AS folder, count(*) AS n
FROM (SELECT {BARE} AS bare FROM pages)
WHERE lower(regexp_extract(string_split(bare, '/')[-1], '(\\.[^.]+)$', 1)) IN ('.html', '.htm') GROUP BY 1""")
def path_count(spark, sf_dir):
    return files.count_by_folder(table(spark, sf_dir, "pages").select(F.col("url").alias("path")), [".html", ".htm"])


@query("label_union", f"""
WITH {V_DOC}
SELECT doc_id, lang, n_chars, 0 AS label FROM v_doc WHERE quality = 1
UNION ALL SELECT doc_id, lang, n_chars, 1 AS label FROM v_doc WHERE quality = 0""")
def label_union(spark, sf_dir):
    docs = documents_view(spark, sf_dir)
    keep = ["doc_id", "lang", "n_chars"]
    return files.labelled_union(
        docs.filter(F.col("quality") == 1).select(*keep), docs.filter(F.col("quality") == 0).select(*keep)
    )


@query("sink_roundtrip", f"""
WITH {V_RES}
SELECT model, scenario, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, 'run_a' AS run_id FROM v_res
UNION ALL SELECT model, scenario, round(accuracy, 6), round(f1, 6), 'run_b' FROM v_res WHERE scenario = 'W1'""")
def sink_roundtrip(spark, sf_dir):
    result = results_view(spark, sf_dir).select("model", "scenario", *rounded("accuracy", "f1"))
    path = scratch_path(spark, "results")
    tables.write_table(result, path, "csv", run_id="run_a")
    tables.write_table(result.filter(F.col("scenario") == "W1"), path, "csv", run_id="run_b")
    return tables.read_table(
        spark, path, "csv", "model string, scenario string, accuracy double, f1 double, run_id string"
    )


@query("config_json", f"""
WITH {V_RES}
SELECT model, scenario, round(accuracy, 6) AS accuracy, '{{"name":"' || model || '","base":{{"scenario":"' || scenario
  || '","size":[256,256]}}}}' AS config, scenario AS parsed_scenario, 256 AS parsed_width
FROM v_res""")
def config_json(spark, sf_dir):
    config = F.struct(
        F.col("model").alias("name"),
        F.struct("scenario", F.array(F.lit(256), F.lit(256)).alias("size")).alias("base"),
    )
    records = results_view(spark, sf_dir).select("model", "scenario", *rounded("accuracy"), F.to_json(config).alias("config"))
    path = scratch_path(spark, "configs")
    tables.write_table(records, path, "json")
    back = tables.read_table(spark, path, "json", "model string, scenario string, accuracy double, config string")
    parsed = F.from_json("config", "name string, base struct<scenario: string, size: array<int>>")
    return back.withColumn("c", parsed).select(
        "model", "scenario", "accuracy", "config", F.col("c.base.scenario").alias("parsed_scenario"),
        F.col("c.base.size")[0].alias("parsed_width"),
    )


@query("fitted_roundtrip", f"""
WITH {V_ORD}, s AS (SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1, avg(c_acctbal) AS m2,
                           stddev_pop(c_acctbal) AS s2 FROM v_ord)
SELECT o_orderkey, round((o_totalprice - m1) / s1, 6) AS o_totalprice, round((c_acctbal - m2) / s2, 6) AS c_acctbal
FROM v_ord, s""")
def fitted_roundtrip(spark, sf_dir):
    orders = orders_view(spark, sf_dir, lines=False)
    columns = ["o_totalprice", "c_acctbal"]
    path = scratch_path(spark, "fitted")
    tables.write_table(scale.fit_standard(orders, columns), path)
    scaled = scale.transform(orders, tables.read_table(spark, path), columns)
    return scaled.select("o_orderkey", *rounded(*columns))
