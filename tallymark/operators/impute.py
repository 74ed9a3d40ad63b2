"""Filling missing values."""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.neighbours import MATRIX_CELLS, best_of_rows, block_join, key_order, knn_join
from tallymark.operators.ranking import quantile_row
from tallymark.session import written

# Patterns of gaps that get a neighbour join each.
MAX_PATTERNS = 64
# Pairs of gaps and donors with gaps that pay for joins of their own.
MANY_PAIRS = 1_000_000_000


def fill_with(df: DataFrame, values: dict) -> DataFrame:
    """Nulls of each column replaced by its fitted value."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fit_mean(df: DataFrame, columns: list[str]) -> dict:
    return df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()


def fit_median(df: DataFrame, columns: list[str]) -> dict:
    fitted = quantile_row(df, columns, {"median": 0.5})
    return {c: fitted[c]["median"] for c in columns}


def fit_mode(df: DataFrame, columns: list[str]) -> dict:
    """Most frequent value; the smallest value wins a tie. All columns are counted in one pass."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.explode(entries).alias("e")).select("e.*").filter("value is not null")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    # max_by over a struct combines on the map side; no window over a column's levels. The largest count comes first,
    # then the smallest value, so the count is negated and min_by takes the first struct.
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    return {r["column"]: r["value"] for r in best.collect()}


def impute_knn(df: DataFrame, key: str, columns: list[str], k: int = 5) -> DataFrame:
    """Fill each missing value with the mean over its k nearest donors; ties by donor key.

    Distance runs over the coordinates both rows have, scaled by total over present coordinates. A donor must have the
    wanted column and share a coordinate. Without a donor the column mean is used.

    Rows with equal gaps form a pattern. Among complete donors the distance is Euclidean on the pattern's coordinates, so
    each pattern gets its own neighbour join, which skips donors out of reach where that pays. Donors with gaps of their own
    are compared in blocks (see ``block_join``), as all donors are when there are more than MAX_PATTERNS patterns; those that share
    no coordinate or lack every wanted column are left out. Above MANY_PAIRS pairs each two patterns get a join as well, if these are
    MAX_PATTERNS at most and no donors share a key.
    """
    means = fit_mean(df, columns)
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns])
    present = F.concat(*[F.when(F.col(c).cast("double").isNull() | F.isnan(F.col(c).cast("double")), "0").otherwise("1") for c in columns])
    slim = written(df.select(F.col(key).alias("key"), values.alias("v"), present.alias("pattern")))
    whole, none = "1" * len(columns), "0" * len(columns)
    gaps, donors = slim.filter(F.col("pattern") != whole), slim.filter(F.col("pattern") != none)
    patterns = [r[0] for r in gaps.filter(F.col("pattern") != none).groupBy("pattern").count().orderBy("pattern").limit(MAX_PATTERNS + 1).select("pattern").collect()]
    helps = lambda p, q: any(a == b == "1" for a, b in zip(p, q)) and any((a, b) == ("0", "1") for a, b in zip(p, q))
    kind = df.schema[key].dataType.simpleString()
    found = []
    if len(patterns) <= MAX_PATTERNS:
        complete, donors = donors.filter(F.col("pattern") == whole), donors.filter(F.col("pattern") != whole)
        found = [_pattern_neighbours(gaps.filter(F.col("pattern") == p), complete, p, whole, k) for p in patterns]
        pairs = [(p, q) for p, q in product(patterns, patterns) if helps(p, q)]
        gaps, donors = (side.filter(F.col("pattern").isin(sorted(set(x)))) for side, x in zip((gaps, donors), zip(*pairs))) if pairs else (gaps, donors.limit(0))
        if len(pairs) <= MAX_PATTERNS and gaps.count() * donors.count() > MANY_PAIRS and _one_row_a_key(donors):
            found += [_pattern_neighbours(gaps.filter(F.col("pattern") == p), donors.filter(F.col("pattern") == q), p, q, k) for p, q in pairs]
            donors = donors.limit(0)
    if not found or not donors.isEmpty():
        found.append(_partial_neighbours(gaps.filter(F.col("pattern") != none), donors, len(columns), k, kind))
    best = Window.partitionBy("left_key", "j").orderBy("distance", "right_key")
    filled = (
        reduce(DataFrame.unionByName, found).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k)
        .groupBy("left_key").pivot("j", list(range(len(columns)))).agg(F.avg("value"))
    )
    renamed = filled.select(F.col("left_key").alias("__key"), *[F.col(str(j)).alias(f"__f{j}") for j in range(len(columns))])
    joined = df.join(renamed, df[key] == renamed["__key"], "left")
    values = {c: F.coalesce(F.col(c), F.col(f"__f{j}"), F.lit(means[c])) for j, c in enumerate(columns)}
    return joined.withColumns(values).select(*df.columns)


def _one_row_a_key(df: DataFrame) -> bool:
    return df.groupBy("key").count().filter("key is null or count > 1").isEmpty()


def _pattern_neighbours(gaps: DataFrame, donors: DataFrame, pattern: str, given: str, k: int) -> DataFrame:
    """left_key, j, right_key, distance, value of the k nearest donors with pattern ``given`` of rows with one pattern of gaps."""
    mine = [j for j, (c, g) in enumerate(zip(pattern, given)) if c == g == "1"]
    wanted = [j for j, (c, g) in enumerate(zip(pattern, given)) if c == "0" and g == "1"]
    at = F.array(*[F.col("v")[j] for j in mine])
    pairs = knn_join(gaps.withColumn("at", at), donors.withColumn("at", at), k, "key", "key", "at", "at")
    values = donors.select(F.col("key").alias("right_key"), F.array(*[F.struct(F.lit(j).alias("j"), F.col("v")[j].alias("value")) for j in wanted]).alias("given"))
    scaled = F.col("distance") * F.lit(math.sqrt(len(pattern) / len(mine)))
    return pairs.join(values, "right_key").select("left_key", "right_key", scaled.alias("distance"), F.explode("given").alias("g")).select("left_key", "g.j", "right_key", "distance", "g.value")


def _partial_neighbours(gaps: DataFrame, donors: DataFrame, width: int, k: int, kind: str) -> DataFrame:
    """The same among donors of any pattern, for rows of any pattern."""

    def nearest(left_keys, left, right_keys, right):
        present = ~np.isnan(right)
        filled, place, out = np.where(present, right, 0.0), key_order(right_keys), []
        patterns, member = np.unique(~np.isnan(left), axis=0, return_inverse=True)
        for number, mine in enumerate(patterns):
            rows = np.flatnonzero(member.ravel() == number)
            # How many coordinates are shared depends on the pattern and the donor only.
            shared = present[:, mine].sum(axis=1)
            targets: dict[bytes, list[int]] = {}
            for j in np.flatnonzero(~mine):
                targets.setdefault((present[:, j] & (shared > 0)).tobytes(), []).append(int(j))
            for allowed, columns_of in targets.items():
                donor = np.flatnonzero(np.frombuffer(allowed, dtype=bool))
                if not len(donor):
                    continue
                step = max(1, MATRIX_CELLS // len(donor))
                for part in (rows[i:i + step] for i in range(0, len(rows), step)):
                    dist = np.zeros((len(part), len(donor)))
                    for j in np.flatnonzero(mine):
                        gap = (left[part, j, None] - filled[None, donor, j]) * present[donor, j]
                        dist += gap * gap
                    dist = np.sqrt(width / shared[donor] * dist)
                    near = dist <= np.partition(dist, k - 1, axis=1)[:, k - 1, None] if len(donor) > k else np.ones(dist.shape, bool)
                    row, col = np.nonzero(near)
                    best = best_of_rows(row, dist[row, col], place[donor[col]], k)
                    row, col = row[best], col[best]
                    out += [(left_keys[part[row]], np.full(len(row), j, np.int32), right_keys[donor[col]], dist[row, col], right[donor[col], j]) for j in columns_of]
        return tuple(np.concatenate(x) for x in zip(*out)) if out else ([], [], [], [], [])

    schema = f"left_key {kind}, j int, right_key {kind}, distance double, value double"
    return block_join(gaps.select("key", "v"), donors.select("key", "v"), nearest, schema)
