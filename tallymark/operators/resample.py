"""Synthetic minority rows, feature noise and coresets."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.rng import gauss, u
from tallymark.operators.cluster import slices, squares_to
from tallymark.operators.moments import few_tasks
from tallymark.operators.neighbours import key_order, knn_join
from tallymark.operators.ranking import bucket_count, with_range_bucket, with_row_number
from tallymark.session import attach, written

# Noise multipliers of the three parts; fixed values of the workload.
NOISE_STEPS = [0.5, 1.0, 2.0]
# Farthest rows that a pass of the coreset returns, and rows of a group that one task selects from.
POOL = 1_024
GROUP_ROWS = 20_000


def smote(df: DataFrame, key: str, label: str, vec: str, k: int = 5, pivots: int | None = None) -> DataFrame:
    """Bring the smaller of two classes to parity with synthetic rows: ``key, label, vec, synthetic``.

    A synthetic row lies between a minority row and one of its k nearest minority rows. Which row, which neighbour and
    how far are draws keyed by the number of the synthetic row, so the work is three equi-joins on evenly drawn keys.
    Synthetic keys count down from -1. ``pivots`` as in ``knn_join``.
    """
    real = df.select(key, label, F.col(vec).cast("array<double>").alias(vec), F.lit(False).alias("synthetic"))
    counts = {r[label]: r["count"] for r in real.groupBy(label).count().collect()}
    if len(counts) != 2:
        raise ValueError("smote needs two classes")
    (minority, n_min), (_, n_max) = sorted(counts.items(), key=lambda c: (c[1], c[0]))
    if n_min == n_max:
        return real
    neighbours = min(k, n_min - 1)
    if neighbours == 0:
        raise ValueError("smote needs two minority rows")
    # Used by the ranking and twice by the joins, so it is written once.
    few = written(real.filter(F.col(label) == minority).select(F.col(key).alias("key"), F.col(vec).alias("v")))
    ranged = with_range_bucket(few, "key", "__range", bucket_count(few))
    ranked = with_row_number(ranged, "rank", [F.col("key")], F.col("__range")).select("rank", "key", "v")
    near = knn_join(few, few, neighbours, "key", "key", "v", "v", exclude_self=True, pivots=pivots)
    near = near.select(F.col("left_key").alias("key"), F.col("rank").alias("nn"), F.col("right_key").alias("other"))
    draws = df.sparkSession.range(n_max - n_min).select(
        "id", (F.floor(u("id", "base") * n_min) + 1).alias("rank"),
        (F.floor(u("id", "nn") * neighbours) + 1).cast("int").alias("nn"), u("id", "gap").alias("gap"),
    )
    others = few.select(F.col("key").alias("other"), F.col("v").alias("w"))
    # A small minority class is broadcast, because its few rows would be hot keys; a large one has no hot rows.
    joined = attach(attach(draws, ranked, ["rank"], "inner"), near, ["key", "nn"], "inner")
    joined = attach(joined, others, ["other"], "inner")
    between = F.zip_with("v", "w", lambda a, b: a + F.col("gap") * (b - a))
    made = joined.select(
        (-1 - F.col("id")).alias(key), F.lit(minority).cast(df.schema[label].dataType).alias(label), between.alias(vec),
        F.lit(True).alias("synthetic"),
    )
    return real.unionByName(made)


def noised(df: DataFrame, key: str, vec: str, sigma: float, thirds: bool = True, output: str = "noised") -> DataFrame:
    """Add Gaussian noise to every coordinate.

    With ``thirds`` the rows in key order fall into three parts with 0.5, 1 and 2 sigma; the last part takes the rest.
    """
    if thirds:
        ranged = with_range_bucket(df, key, "__range", bucket_count(df))
        numbered = with_row_number(ranged, "__r", [F.col(key)], F.col("__range"))
        size = df.count() // 3
        part = F.least(F.floor((F.col("__r") - 1) / max(size, 1)), F.lit(2)) if size else F.lit(2)
        steps = F.array(*[F.lit(sigma * m) for m in NOISE_STEPS])
        df = numbered.withColumn("__sd", F.element_at(steps, (part + 1).cast("int"))).drop("__r", "__range")
    else:
        df = df.withColumn("__sd", F.lit(sigma))
    cell = lambda i: F.concat_ws("_", F.col(key).cast("string"), i.cast("string"))
    shaken = F.transform(F.col(vec), lambda x, i: x + F.col("__sd") * gauss(cell(i)))
    return df.withColumn(output, shaken).drop("__sd")


def coreset_greedy(df: DataFrame, key: str, vec: str, k: int, pool: int = POOL) -> DataFrame:
    """Greedy farthest-point selection: ``key, vec, round, gap`` from the smallest key on, ties by key.

    Every row lies within twice the radius of the best possible choice of k rows. ``k = -1``, or k not below the row count,
    selects all rows.

    A pass multiplies the rows with all chosen ones and returns the ``pool`` rows farthest from them. Distances only shrink,
    so the rows outside never come before the last one of the pool: as long as the best row of the pool, updated after each
    choice, beats that mark, it is the farthest of all, and one pass serves many choices. Rows are written once and carry
    no state from pass to pass; the driver holds the pool and the chosen rows.
    """
    rows = written(df.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("vec")))
    kind = rows.schema["key"].dataType.simpleString()
    if k == -1 or k >= rows.count():
        return rows.select(F.col("key").alias(key), F.col("vec").alias(vec), F.lit(None).cast("int").alias("round"), F.lit(None).cast("double").alias("gap"))
    first = rows.agg(F.min_by(F.struct("key", "vec"), "key").alias("r")).first()["r"]
    chosen = [(first["key"], list(first["vec"]), 0, None)]
    while len(chosen) < k:
        keys, vectors, near = _farthest(rows, np.array([c[1] for c in chosen]), [c[0] for c in chosen], pool, kind)
        mark = (near[-1], keys[-1]) if len(keys) == pool else None
        free = np.ones(len(keys), bool)
        while len(chosen) < k and free.any():
            best = near[free].max()
            at = min(np.flatnonzero(free & (near == best)), key=lambda i: keys[i])
            if mark is not None and (best < mark[0] or (best == mark[0] and keys[at] > mark[1])):
                break
            chosen.append((keys[at], vectors[at].tolist(), len(chosen), float(best)))
            free[at] = False
            near = np.minimum(near, np.sqrt(squares_to(vectors, vectors[at:at + 1])[:, 0]))
    chosen = [(c[0].item() if isinstance(c[0], np.generic) else c[0], *c[1:]) for c in chosen]
    return df.sparkSession.createDataFrame(chosen, f"{key} {kind}, {vec} array<double>, round int, gap double")


def _farthest(rows: DataFrame, centres: np.ndarray, taken: list, pool: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, vectors and distances of the rows not yet taken that are farthest from their nearest centre, in order; ties by key."""

    def top(batches):
        keys, vectors, near = np.zeros(0, object), np.zeros((0, centres.shape[1])), np.zeros(0)
        cc = (centres * centres).sum(axis=1)
        for part, x in slices(batches, "vec", len(centres)):
            left = ~part["key"].isin(taken).to_numpy()
            part, x = part[left], x[left]
            if not len(x):
                continue
            xx = (x * x).sum(axis=1)
            about = np.min(cc[None, :] - 2.0 * (x @ centres.T), axis=1) + xx
            margin = 1e-10 * (1.0 + xx + cc.max())
            # Only rows that can be in the pool get their exact distance.
            floor = max(np.partition(about - margin, -pool)[-pool] if len(x) > pool else -np.inf, near[-1] ** 2 * (1 - 1e-9) if len(near) == pool else -np.inf)
            can = np.flatnonzero(about + margin >= floor)
            if not len(can):
                continue
            exact = np.concatenate([np.sqrt(squares_to(x[i], centres).min(axis=1)) for i in np.array_split(can, -(-len(can) // 1_024))])
            keys, vectors, near = np.concatenate([keys, part["key"].to_numpy(dtype=object)[can]]), np.vstack([vectors, x[can]]), np.concatenate([near, exact])
            order = np.lexsort((key_order(keys), -near))[:pool]
            keys, vectors, near = keys[order], vectors[order], near[order]
        yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "vec": pd.Series(list(vectors), dtype=object), "near": near})

    found = few_tasks(rows).mapInPandas(top, f"key {kind}, vec array<double>, near double").orderBy(F.desc("near"), "key").limit(pool).collect()
    keys = np.array([r["key"] for r in found], object)
    return keys, np.array([r["vec"] for r in found]).reshape(len(found), -1), np.array([r["near"] for r in found])


def coreset_two_rounds(df: DataFrame, key: str, vec: str, k: int, group_rows: int = GROUP_ROWS, pool: int = POOL) -> DataFrame:
    """Farthest-point selection in two rounds: ``key, vec, round, gap``.

    The rows are dealt into groups by a hash of their key; every group selects k of its rows in one task, and the selection
    proper runs over those. One pass over the rows, whatever k is; every row lies within four times the best radius.
    """
    rows = written(df.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("vec")))
    n = rows.count()
    if k == -1 or k >= n:
        return coreset_greedy(df, key, vec, k)
    groups = max(1, math.ceil(n / max(group_rows, 4 * k)))
    kind = rows.schema["key"].dataType.simpleString()

    def select(part: pd.DataFrame) -> pd.DataFrame:
        part = part.iloc[np.argsort(key_order(part["key"].to_numpy()))]
        x = np.stack(part["vec"].to_numpy())
        at, near = [0], np.sqrt(squares_to(x, x[:1])[:, 0])
        while len(at) < min(k, len(x)):
            near[at[-1]] = -1.0
            at.append(int(near.argmax()))  # the first of equal ones, that is the least key
            near = np.where(near < 0, near, np.minimum(near, np.sqrt(squares_to(x, x[at[-1]][None])[:, 0])))
        return part.iloc[at][["key", "vec"]]

    local = rows.groupBy(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("g")).applyInPandas(select, f"key {kind}, vec array<double>")
    return coreset_greedy(local.select(F.col("key").alias(key), F.col("vec").alias(vec)), key, vec, k, pool)
