"""``python -m tests.run_oracles [sf] [name ..]``: checks registered queries against their SQL."""

from __future__ import annotations

import sys
import tempfile
import time

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.oracle import compare, connect


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="oracles-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                state, detail = compare(df, con, oracles[name])
            else:
                state, detail = "rows", str(df.count())
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            state, detail = "ERROR", str(error)[:600]
        if state != "exact" or wanted:
            print(f"{state:8s} {name:28s} {time.time() - start:6.2f}s {detail[:900]}", flush=True)
        else:
            print(f"{state:8s} {name:28s} {time.time() - start:6.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
