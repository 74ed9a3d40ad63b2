"""Sums of arrays of numbers that tasks return: gradients, Hessians, cross products, cluster totals.

A pass reads its rows in few tasks (at most twice the slots of the cluster, each going through several input splits without
a shuffle), so what is merged grows with the width of the cluster and never with the number of input files. The arrays are
merged in a tree of tasks with a bounded fan-in; what reaches the driver is FAN_IN arrays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import parallelism

# Arrays that one task of the tree adds up.
FAN_IN = 16


def few_tasks(df: DataFrame) -> DataFrame:
    """``df`` read by at most twice as many tasks as there are slots; neighbouring input splits are read one after another."""
    return df.coalesce(2 * parallelism(df.sparkSession))


def tree_sum(parts: DataFrame, width: int, value: str = "value") -> DataFrame:
    """FAN_IN arrays at most that sum up to all arrays, merged FAN_IN at a time; ``width`` bounds how many there are."""
    fields = "node int, value array<double>"
    nodes = parts.select(F.spark_partition_id().alias("node"), F.col(value).alias("value"))

    def add(table: pa.Table) -> pa.Table:
        total = None
        for cell in table.column("value"):
            array = cell.values.to_numpy(zero_copy_only=False)
            total = array.copy() if total is None else total + array
        return pa.table({"node": table.column("node").slice(0, 1).cast(pa.int32()), "value": pa.array([total.tolist()], pa.list_(pa.float64()))})

    while width > FAN_IN:
        width = -(-width // FAN_IN)
        nodes = nodes.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int")).groupBy("node").applyInArrow(add, fields)
    return nodes.select("value")


def merged(parts: DataFrame, value: str = "value") -> np.ndarray | None:
    """The element-wise sum of the arrays that the tasks of a ``few_tasks`` pass return, None if there are none."""
    rows = tree_sum(parts, 2 * parallelism(parts.sparkSession), value).collect()
    return np.sum([np.array(r["value"]) for r in rows], axis=0) if rows else None


def cross_products(df: DataFrame, vec: str, mean: np.ndarray) -> tuple[np.ndarray, int]:
    """Centred cross products of the coordinates and the number of rows. Tasks return the packed upper triangle."""
    d = len(mean)
    upper = np.triu_indices(d)

    def partial(batches):
        total, rows = np.zeros((d, d)), 0
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy()) - mean
                total += x.T @ x
                rows += len(x)
        yield pd.DataFrame({"value": [np.append(total[upper], rows).tolist()]})

    parts = few_tasks(df.select(F.col(vec).cast("array<double>").alias("v"))).mapInPandas(partial, "value array<double>")
    sums = merged(parts)
    if sums is None:
        return np.zeros((d, d)), 0
    whole = np.zeros((d, d))
    whole[upper] = sums[:-1]
    return whole + np.triu(whole, 1).T, int(sums[-1])
