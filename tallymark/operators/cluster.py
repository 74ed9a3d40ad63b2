"""k-means with many starts, and several k, advanced together.

All starts of all k share every pass over the rows: a task multiplies a batch with all centres at once, adds up the rows of
each cluster and returns one small matrix, and one iteration of every start is one aggregate. Starts that have settled leave
the later passes. Starting centres are drawn by k-means++ from hash draws; the first k draws of a start serve every k.

A start has settled when the squared moves of its centres sum up to at most ``TOLERANCE`` mean variances of the coordinates.
It keeps the centres of its last pass, and its inertia is that of the rows' distances to them. A cluster that loses all rows
keeps its centre.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallymark.functions.rng import draws, u
from tallymark.operators.features import width_of
from tallymark.operators.moments import few_tasks, merged
from tallymark.session import parallelism, written

RESTARTS, MAX_ITER = 10, 300
TOLERANCE = 1e-4
# Cells of the distance matrix of one batch, and of a part of it that stays in a core's cache.
CELLS = 4_000_000
CACHED_CELLS = 32_768
# Centres whose distances to some rows are worked out together.
GROUP = 64
# Rows whose distances come from one matrix product, bytes of vectors that are packed together, and that are worked on together.
PRODUCT_ROWS, PACKED_BYTES, UNPACKED_BYTES = 1_024, 4_096, 1 << 20
# Squares from which single precision is not tried.
LARGEST_SQUARE = 1e30


@dataclass
class Clusters:
    """The best start of one k."""

    centres: np.ndarray
    inertia: float
    start: int
    iterations: int


def squares_to(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, from coordinate differences, so that equal centres give equal distances."""
    out, columns = np.zeros((len(centres), len(x))), np.ascontiguousarray(x.T)
    step = max(1, CACHED_CELLS // max(len(centres), 1))
    for at in range(0, len(x), step):
        _add_squares(columns[:, at:at + step], centres, out[:, at:at + step])
    return out.T


def _add_squares(columns: np.ndarray, centres: np.ndarray, out: np.ndarray) -> None:
    """Adds the squared distances of the rows in ``columns`` (width x rows) to ``out`` (centres x rows)."""
    gap = np.empty(out.shape)
    for j in range(len(columns)):
        np.subtract(columns[j], centres[:, j, None], out=gap)
        np.multiply(gap, gap, out=gap)
        np.add(out, gap, out=out)


def add_clusters(x: np.ndarray, flat: np.ndarray, bounds: np.ndarray, total: np.ndarray, inertia: np.ndarray) -> None:
    """Adds the rows of ``x`` to the sums (and counts, the last column) of their clusters in every start.

    Centres ``bounds[i]`` to ``bounds[i + 1]`` of ``flat`` belong to start i; a row goes to the first of its nearest.
    """
    group = [0]
    for i in range(1, len(bounds) - 1):
        if bounds[i + 1] - bounds[group[-1]] > GROUP:
            group.append(i)
    group.append(len(bounds) - 1)
    columns, rows = np.ascontiguousarray(x.T), np.hstack([x, np.ones((len(x), 1))])
    finite = bool(np.isfinite(x).all())
    for first, end in zip(group[:-1], group[1:]):
        low, high = bounds[first], bounds[end]
        step = max(256, CACHED_CELLS // max(high - low, 1))
        for at in range(0, len(x), step):
            squares = np.zeros((high - low, len(rows[at:at + step])))
            _add_squares(columns[:, at:at + step], flat[low:high], squares)
            member = np.empty(squares.shape, bool)
            for i in range(first, end):
                part = slice(bounds[i] - low, bounds[i + 1] - low)
                least = squares[part].min(axis=0)
                inertia[i] += least.sum()
                np.equal(squares[part], least, out=member[part])
                if np.count_nonzero(member[part]) != len(least):
                    member[part] = squares[part].argmin(axis=0) == np.arange(bounds[i + 1] - bounds[i])[:, None]
            if finite:
                total[low:high] += member.astype(float) @ rows[at:at + step]
            else:  # a product would carry what is no number into every cluster
                total[low:high] += [rows[at:at + step][m].sum(axis=0) for m in member]


def slices(batches: Iterator[pd.DataFrame], vec: str, width: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for batch in batches:
        step = max(1, CELLS // max(width, 1))
        for at in range(0, len(batch), step):
            part = batch.iloc[at:at + step]
            yield part, np.stack(part[vec].to_numpy())


def matrices(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The vectors of an Arrow column as matrices whose distances to ``width`` centres fit in memory."""
    step = max(1, CELLS // max(width, 1))
    for at in range(0, len(column), step):
        part = column.slice(at, step)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def starting_centres(rows: DataFrame, k: int, restarts: int) -> np.ndarray:
    """k-means++ centres (restarts x k x width): one pass draws the next centre of every start.

    The first is the row with the least draw. A later one is the row with the least -ln(draw) / d, d being the squared
    distance to the nearest centre so far, which chooses a row with probability proportional to d. Ties go by key. The draws are
    worked out in the tasks for whole-number keys, else by Spark; a row whose draw cannot win at the widest distance of its batch is
    not measured.
    """
    kind = rows.schema["key"].dataType
    whole = isinstance(kind, IntegralType)
    chosen: list[list] = [[] for _ in range(restarts)]
    for j in range(k):
        centres = np.array(chosen) if j else None

        def race(batches, j=j, centres=centres):
            best: dict[int, tuple] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, x = batch.column("key"), next(matrices(batch.column("vec"), 1))
                if whole:
                    numbers = np.ma.masked_array(keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_null().to_numpy(zero_copy_only=False))
                    drawn = draws(numbers, [f"start{s}_{j}" for s in range(restarts)])
                low, high = x.min(axis=0), x.max(axis=0)
                for s in range(restarts):
                    draw = drawn[s] if whole else batch.column(f"u{s}").to_numpy()
                    able = np.arange(len(x))
                    if j:
                        with np.errstate(invalid="ignore"):
                            widest = np.maximum((low - centres[s]) ** 2, (high - centres[s]) ** 2).sum(axis=1).min()
                            if s in best and np.isfinite(best[s][0] * widest):
                                able = np.flatnonzero(draw >= math.exp(-best[s][0] * widest * (1 + 1e-9)) * (1 - 1e-9))
                                if not len(able):
                                    continue
                        near = squares_to(x[able], centres[s]).min(axis=1)
                        with np.errstate(divide="ignore"):
                            time = np.where(near > 0, -np.log(draw[able]) / np.where(near > 0, near, 1.0), np.inf)
                    else:
                        time = draw
                    for i in able[time == time.min()]:
                        key = keys[int(i)].as_py()
                        found = (float(time.min()), (key is not None, key), x[i].tolist())
                        if s not in best or found[0] < best[s][0] or found[0] == best[s][0] and found[1] != best[s][1] and (not found[1][0] or best[s][1][0] and key < best[s][1][1]):
                            best[s] = found
            if best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(best), pa.int32()), pa.array([b[0] for b in best.values()]), pa.array([b[1][1] for b in best.values()], keys.type), pa.array([b[2] for b in best.values()], pa.list_(pa.float64()))],
                    names=["start", "time", "key", "vec"],
                )

        columns = [] if whole else [u("key", f"start{s}_{j}").alias(f"u{s}") for s in range(restarts)]
        raced = rows.select("key", "vec", *columns).mapInArrow(race, f"start int, time double, key {kind.simpleString()}, vec array<double>")
        for r in raced.groupBy("start").agg(F.min_by("vec", F.struct("time", "key")).alias("vec")).collect():
            chosen[r["start"]].append(list(r["vec"]))
    return np.array(chosen)


def mean_variance(rows: DataFrame) -> float:
    """Mean of the coordinates' variances."""
    width = width_of(rows, "vec") if not rows.isEmpty() else 0
    return float(np.mean(rows.agg(*[F.var_pop(F.col("vec")[i]) for i in range(width)]).first())) if width else 0.0


def add_sums(x: np.ndarray, flat: np.ndarray, bounds: np.ndarray, total: np.ndarray) -> None:
    """What ``add_clusters`` adds to ``total``, from matrix products.

    Distances are compared about the mean of the centres, up to the square of the row, in single precision. Rows that two centres of a
    start are as near to within its rounding are measured as ``add_clusters`` does. Sums are in double precision.
    """
    middle = flat.mean(axis=0)
    centres = flat - middle
    squares, widest = ((x - middle) ** 2).sum(axis=1), (centres * centres).sum(axis=1).max()
    if not squares.max(initial=0.0) + widest < LARGEST_SQUARE:  # or no number
        add_clusters(x, flat, bounds, total, np.zeros(len(bounds) - 1))
        return
    sizes, runs = np.diff(bounds), [0]
    for i in range(1, len(sizes)):
        if sizes[i] != sizes[i - 1] or bounds[i + 1] - bounds[runs[-1]] > GROUP:
            runs.append(i)
    runs.append(len(sizes))
    weights = np.hstack([-2.0 * centres, (centres * centres).sum(axis=1, keepdims=True)]).astype(np.float32)
    rows, about = np.hstack([x, np.ones((len(x), 1))]), np.vstack([(x - middle).T, np.ones(len(x))]).astype(np.float32)
    fine = (2e-7 * (x.shape[1] + 4) * (squares + 2.0 * widest)).astype(np.float32)
    most = PRODUCT_ROWS * max(bounds[end] - bounds[first] for first, end in zip(runs[:-1], runs[1:]))
    scores, hits, members = np.empty(most, np.float32), np.empty(most, bool), np.empty(most)
    for at in range(0, len(x), PRODUCT_ROWS):
        own, near, close = rows[at:at + PRODUCT_ROWS], np.ascontiguousarray(about[:, at:at + PRODUCT_ROWS]), fine[at:at + PRODUCT_ROWS]
        for first, end in zip(runs[:-1], runs[1:]):
            part = slice(bounds[first], bounds[end])
            shape, cells = (end - first, sizes[first], len(own)), (bounds[end] - bounds[first]) * len(own)
            score, hit = scores[:cells].reshape(shape), hits[:cells].reshape(shape)
            np.matmul(weights[part], near, out=score.reshape(-1, len(own)))
            limit = score.min(axis=1, keepdims=True)
            limit += close
            np.less_equal(score, limit, out=hit)
            if np.count_nonzero(hit) != limit.size:
                doubt = np.add.reduce(hit, axis=1, dtype=np.int32) > 1
                for i in np.flatnonzero(doubt.any(axis=1)):
                    which = np.flatnonzero(doubt[i])
                    exact = squares_to(own[which, :-1], flat[bounds[first + i]:bounds[first + i + 1]]).argmin(axis=1)
                    hit[i][:, which] = exact == np.arange(sizes[first])[:, None]
            member = members[:cells].reshape(-1, len(own))
            np.copyto(member, hit.reshape(member.shape))
            total[part] += member @ own


def packed(rows: DataFrame, width: int) -> DataFrame:
    """``x``: vectors as they lie in memory, some kilobytes together, so that a pass does not convert them one by one."""
    size = max(1, PACKED_BYTES // (8 * max(width, 1)))

    def pack(batches):
        for batch in batches:
            for x in matrices(batch.column("vec"), 1):
                yield pa.RecordBatch.from_arrays([pa.array([x[at:at + size].tobytes() for at in range(0, len(x), size)], pa.binary())], names=["x"])

    return written(rows.select("vec").mapInArrow(pack, "x binary"))


def unpacked(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The vectors of a ``packed`` column as matrices of about ``UNPACKED_BYTES``."""
    step = UNPACKED_BYTES // PACKED_BYTES
    for at in range(0, len(column), step):
        yield np.frombuffer(b"".join(column.slice(at, step).to_pylist())).reshape(-1, width)


def lloyd(rows: DataFrame, starts: dict, max_iter: int = MAX_ITER) -> dict[tuple, Clusters]:
    """Run every start (name -> centres) until it settles; one aggregate per iteration for all of them, and one for the inertias."""
    active, done = {name: np.asarray(c, dtype=float) for name, c in starts.items()}, {}
    width = len(next(iter(active.values()))[0])
    vectors = few_tasks(packed(rows, width))
    least = TOLERANCE * mean_variance(rows)

    def summed(add, centres: dict) -> tuple[np.ndarray, np.ndarray] | None:
        """Sums and counts of the clusters (the last column) and inertias of the starts; ``add`` adds those of some rows."""
        flat, bounds = np.vstack(list(centres.values())), np.cumsum([0] + [len(c) for c in centres.values()])

        def partial(batches):
            total, inertia = np.zeros((len(flat), width + 1)), np.zeros(len(bounds) - 1)
            for batch in batches:
                for x in unpacked(batch.column("x"), width):
                    add(x, flat, bounds, total, inertia)
            yield pa.record_batch([pa.array([np.concatenate([total.ravel(), inertia])], pa.list_(pa.float64()))], names=["value"])

        sums = merged(vectors.mapInArrow(partial, "value array<double>"))
        return None if sums is None else (sums[:total_cells(flat)].reshape(len(flat), -1), sums[total_cells(flat):])

    def total_cells(flat: np.ndarray) -> int:
        return len(flat) * (width + 1)

    for iteration in range(1, max_iter + 2):
        found = summed(lambda x, flat, bounds, total, inertia: add_sums(x, flat, bounds, total), active)
        if found is None:
            return {n: Clusters(c, 0.0, 0, 0) for n, c in active.items()}
        parts = np.split(found[0], np.cumsum([len(c) for c in active.values()])[:-1])
        for name, part in zip(list(active), parts):
            filled = part[:, -1:] > 0
            moved = np.where(filled, part[:, :-1] / np.maximum(part[:, -1:], 1), active[name])
            if ((moved - active[name]) ** 2).sum() <= least or iteration > max_iter:
                done[name] = Clusters(active[name], 0.0, 0, iteration - 1)
                del active[name]
            else:
                active[name] = moved
        if not active:
            break
    for name, inertia in zip(done, summed(add_clusters, {name: c.centres for name, c in done.items()})[1]):
        done[name].inertia = float(inertia)
    return done


def kmeans(df: DataFrame, ks: list[int], restarts: int = RESTARTS, max_iter: int = MAX_ITER, key: str = "key", vec: str = "vec") -> dict[int, Clusters]:
    """For each k the start with the least inertia, the first on a tie."""
    rows = df.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("vec"))
    rows = written(rows.repartition(2 * parallelism(df.sparkSession)))  # each pass keeps every slot busy, however few files ``df`` has
    seeds = starting_centres(rows, max(ks), restarts)
    found = lloyd(rows, {(k, s): seeds[s, :k] for k in ks for s in range(len(seeds) if k > 1 else 1)}, max_iter)
    best = {}
    for k in ks:
        start = min((s for j, s in found if j == k), key=lambda s: (round(found[k, s].inertia, 6), s))
        best[k] = Clusters(found[k, start].centres, found[k, start].inertia, start, found[k, start].iterations)
    return best


def assign(df: DataFrame, centres: np.ndarray, vec: str = "vec", output: str = "cluster") -> DataFrame:
    """``df`` with the number of its nearest centre, the first on a tie."""

    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        return pd.Series(squares_to(np.stack(v.to_numpy()), centres).argmin(axis=1) if len(v) else [], dtype="int32")

    return df.withColumn(output, nearest(F.col(vec).cast("array<double>")))


def elbow(df: DataFrame, ks: range, restarts: int = RESTARTS, max_iter: int = MAX_ITER) -> DataFrame:
    """``k, inertia``, the least of several starts."""
    found = kmeans(df, list(ks), restarts, max_iter)
    return df.sparkSession.createDataFrame([(k, found[k].inertia) for k in ks], "k int, inertia double")
