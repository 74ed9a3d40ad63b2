"""Reading and writing tables. Schemas are declared, never inferred, so a scan starts without a pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """Read CSV (with a header row), JSON or Parquet. A missing path raises."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError(f"{fmt} needs a declared schema")
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", run_id: str | None = None) -> None:
    """Write a result table; runs sit side by side in ``run_id=..`` folders, and a run replaces only itself."""
    writer = df.write.mode("overwrite")
    target = path if run_id is None else f"{path.rstrip('/')}/run_id={run_id}"
    if fmt == "csv":
        writer.option("header", True).csv(target)
    else:
        writer.format(fmt).save(target)
