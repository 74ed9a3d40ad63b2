"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores (default 8). Each query is run to
completion through a sink that keeps nothing, after one warm-up of the session; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "scan_project", "null_profile", "corr_matrix", "welch_ttest", "chi2_yates", "box_stats", "label_encode", "impute_median",
    "scale_robust", "winsorize", "scale_percentile_clip", "knn_join_l2", "impute_knn", "smote", "split_stratified",
    "fold_stratified", "roc_auc", "aupro_approx", "memory_bank_score", "covariance_long", "convolve_gaussian", "convolve_gabor",
    "clf_logistic", "clf_gnb", "search_best", "knn_join_pivots", "knn_join_lsh", "coreset_greedy", "kmeans_assign", "variant_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-")).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from queries import QUERIES

    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times = {}
    for name in names:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
