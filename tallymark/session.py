"""Session-level settings: where shared intermediate tables go and how small a side must be to broadcast it."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, NumericType, StringType, StructType

# A fitted table with at most this many rows is collected once and broadcast; a larger one is joined by shuffle.
SMALL_ROWS = 20_000
# Longest value, in bytes, of such a table.
SMALL_VALUE = 4_096


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session may leave the setting out and gets a temporary folder. A cluster must name a shared one, because
    a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not path:
        existing = context.getCheckpointDir()
        if existing:
            return existing
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="tallymark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one intermediate table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and later passes read only the columns they need. The tables stay until
    the folder is cleared.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, 1)


def attach(df: DataFrame, fitted: DataFrame, on: list[str] | tuple[str, ...] = (), how: str = "left") -> DataFrame:
    """Add the columns of a fitted table to every matching row.

    ``fitted`` holds one row per key (one row in all when ``on`` is empty). It is evaluated once. A small one is
    broadcast, so the data is not shuffled; beyond that the join is left to Spark, which splits hot keys.
    Null keys match null keys.
    """
    if not on:
        values = fitted.first()
        return df.withColumns({f.name: F.lit(values[f.name]).cast(f.dataType) for f in fitted.schema.fields})
    side = small(fitted)
    side = side.withColumnsRenamed({c: f"__{c}" for c in on})
    match = reduce(Column.__and__, [df[c].eqNullSafe(side[f"__{c}"]) for c in on])
    return df.join(side, match, how).drop(*[f"__{c}" for c in on])


def few_rows(df: DataFrame, limit: int | None = None) -> list | None:
    """The rows of ``df`` when it is proven small, else None.

    Small means at most ``limit`` rows and no value above ``SMALL_VALUE`` bytes. Longer values are cut before they are
    collected and only reported, so what reaches the driver is bounded either way.
    """
    limit = SMALL_ROWS if limit is None else limit
    cut, wide = [], F.lit(False)
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            too_long, value = F.octet_length(c) > SMALL_VALUE, F.substring(c, 1, SMALL_VALUE)
        elif isinstance(field.dataType, ArrayType):
            flat = isinstance(field.dataType.elementType, NumericType)
            too_long = F.size(c) > SMALL_VALUE // 8 if flat else F.length(F.to_json(F.struct(c))) > SMALL_VALUE
            value = F.when(~too_long, c)
        elif isinstance(field.dataType, BinaryType):
            too_long, value = F.octet_length(c) > SMALL_VALUE, F.substring(c, 1, SMALL_VALUE)
        elif isinstance(field.dataType, (StructType, MapType)):
            too_long = F.length(F.to_json(F.struct(c))) > SMALL_VALUE
            value = F.when(~too_long, c)
        else:
            cut.append(c)
            continue
        cut.append(value.alias(field.name))
        wide = wide | F.coalesce(too_long, F.lit(False))
    rows = df.select(*cut, wide.alias("__wide")).limit(limit + 1).collect()
    if len(rows) > limit or any(r["__wide"] for r in rows):
        return None
    return [tuple(r)[:-1] for r in rows]


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Broadcast side if ``df`` is proven small, else ``df`` unchanged."""
    rows = few_rows(df, limit)
    return df if rows is None else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def settled(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """Evaluate a reduced table once: it is written to the shared folder, and its row count read from the files.

    Returns the table and whether it has few rows.
    """
    table = written(df)
    return table, table.count() <= (SMALL_ROWS if limit is None else limit)
