"""Nearest-neighbour joins: exact ones, and an approximate one with measured recall.

Both sides are hashed into blocks of bounded size and every pair of blocks is one unit of work: a matrix computation
that returns only the k best rows of each left row. No pair of rows is ever shuffled or stored, no side is broadcast
or collected, and a hot key or cluster cannot make a block large because blocks are cut by a hash of the row key. The
work is |left| x |right| distances, spread over all tasks; partial results are merged by a window over the left key.

For large sides with structure ``knn_join`` first groups rows around pivot rows. Distances to the pivots bound the k-th
neighbour distance of each group, and by the triangle inequality only right rows within reach are sent to a group. The
result stays exact. How many pivots pay is decided from the distances in a bounded sample of rows. Large sides of vectors of
few coordinates are joined by cells of a k-d tree instead: their number grows with the right rows, so a cell holds about as many
at any size. A left row meets its own cell first; its k-th neighbour there tells which other cells it has to meet.

``knn_join_lsh`` compares rows that share a bucket of random projections and ranks them by their exact distances. Width
and number of the hash tables follow from the neighbour distances of a bounded sample of left rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.rng import u
from tallymark.session import attach, parallelism, written

BLOCK_ROWS = 32_768
# Bytes of the vectors of one block.
BLOCK_BYTES = 16 << 20
# Cells of one distance matrix, or pairs of rows, held in memory at a time.
MATRIX_CELLS = 2_000_000
# Rows of the right and of the left side that decide how many pivots pay, and the numbers to choose from.
SAMPLE_RIGHT, SAMPLE_LEFT = 1_024, 256
PIVOTS = (16, 64, 256)
# Cells that stay in a core's cache.
CACHED_CELLS = 65_536
# Vectors up to this width are compared leaf by leaf, with leaves of so many left and right rows, if there are many pairs.
LEAF_WIDTH, LEAF_LEFT, LEAF_RIGHT, LEAF_PAIRS = 5, 32, 128, 1_000_000
# Pairs of one bucket that pay for a matrix product of their own.
BUCKET_PAIRS = 20_000
# Pairs of a join that get tasks of their own for each unit of work.
SPREAD_PAIRS = 1_000_000_000
TASKS_A_UNIT, MOST_TASKS = 3, 4_096
# Rows sent to buckets that get a task for each group.
SPREAD_ROWS = 1_000_000
# Vectors up to this width are joined by cells of a k-d tree; right rows of a cell, rows sampled for one, and most cells.
CELL_WIDTH, CELL_ROWS, CELL_SAMPLE, MOST_CELLS = 8, 4_096, 16, 32_768
# Rows of both sides that a task of cells reads, and left rows led through the tree at a time.
CELL_TASK_ROWS, TREE_ROWS = 131_072, 256
# Distances that cost as much as the passes that pivots need on top.
PIVOT_PASSES = 500_000_000


def block_join(left: DataFrame, right: DataFrame, match: Callable, schema: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Apply ``match(left_keys, left_matrix, right_keys, right_matrix)`` to every pair of blocks.

    Both frames have the columns ``key, v array<double>``. ``match`` returns one array for each column of ``schema``.
    """
    cell = F.lit(0).alias("cell")
    (n, width), (m, _) = _shape(left), _shape(right)
    return _join_cells(left.select("key", "v", cell), right.select("key", "v", cell), [n], [m], match, schema, _rows_of(block_rows, width))


def _frame(names: list[str], columns) -> pd.DataFrame:
    """Columns of equal length; text and nothing are plain object columns, which Arrow turns into any type."""
    return pd.DataFrame({n: pd.Series(c, dtype=object) if not len(c) or np.asarray(c).dtype == object else c for n, c in zip(names, columns)})


def _shape(df: DataFrame) -> tuple[int, int]:
    """Rows and longest vector."""
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first())


def _rows_of(block_rows: int, width: int) -> int:
    """Rows of a block, fewer for wide vectors."""
    return max(1, min(block_rows, BLOCK_BYTES // (8 * max(width, 1))))


def _join_cells(
    left: DataFrame, right: DataFrame, left_rows: list[int], right_rows: list[int], match: Callable, schema: str, block_rows: int,
    tasks: int | None = None,
) -> DataFrame:
    """Match the rows of equal cells. A cell with many rows is cut into blocks on both sides by a hash of the row key.

    ``tasks`` share the units; without a number the units decide.
    """
    right_blocks = [max(1, math.ceil(n / block_rows)) for n in right_rows]
    left_blocks = [max(1, math.ceil(n / block_rows)) for n in left_rows]
    units = sum(a * b for a, b in zip(left_blocks, right_blocks))
    if units < parallelism(left.sparkSession):
        more = math.ceil(parallelism(left.sparkSession) / units)
        left_blocks = [n * more for n in left_blocks]

    def blocks_of(sizes: list[int]) -> Column:
        """Blocks of a row's cell; only the cells that differ from the usual number are listed."""
        usual = min(sizes)
        other = [F.lit(x) for c, size in enumerate(sizes) if size != usual for x in (c, size)]
        return F.coalesce(F.element_at(F.create_map(*other), F.col("cell")), F.lit(usual)) if other else F.lit(usual)

    block = lambda sizes, salt: F.pmod(F.xxhash64("key", F.lit(salt)), blocks_of(sizes)).cast("int")
    everywhere = lambda sizes: F.explode(F.sequence(F.lit(0), blocks_of(sizes) - 1))
    lhs = left.select(
        F.col("key").alias("lk"), F.col("v").alias("lv"), F.col("cell").alias("c"), block(left_blocks, "l").alias("i"),
        everywhere(right_blocks).alias("j"),
    )
    rhs = right.select(
        F.col("key").alias("rk"), F.col("v").alias("rv"), F.col("cell").alias("c"), everywhere(left_blocks).alias("i"),
        block(right_blocks, "r").alias("j"),
    )
    names = [part.split()[0] for part in schema.split(",")]

    def pair(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return _frame(names, [[]] * len(names))
        return _frame(names, match(a["lk"].to_numpy(), np.stack(a["lv"].to_numpy()), b["rk"].to_numpy(), np.stack(b["rv"].to_numpy())))

    if tasks is None and sum(a * b for a, b in zip(left_rows, right_rows)) > SPREAD_PAIRS:  # few units in a task, whatever their bytes
        tasks = min(MOST_TASKS, TASKS_A_UNIT * sum(a * b for a, b in zip(left_blocks, right_blocks)))
    if tasks is not None:
        lhs, rhs = (side.repartition(tasks, "c", "i", "j") for side in (lhs, rhs))
    return lhs.groupBy("c", "i", "j").cogroup(rhs.groupBy("c", "i", "j")).applyInPandas(pair, schema)


def _many(shapes: tuple) -> bool:
    """Whether there are enough pairs to pay for passes that tell which of them count."""
    (n, width), (m, _) = shapes
    return n * m * max(width, 1) >= 4 * PIVOT_PASSES and m > PIVOTS[0]


def pivot_count(left: DataFrame, right: DataFrame, shapes: tuple, want: int, p: float, grouped: bool = False) -> int:
    """How many pivots make the join cheapest, 0 for none, judged by a sample of SAMPLE_RIGHT and SAMPLE_LEFT rows.

    The sampled right rows begin with the pivots that the join would take. For each number of pivots the share of right rows
    within reach of the sampled left rows' cells estimates what remains to be compared.
    """
    (n, width), (m, _) = shapes
    plain = n * m
    if not _many(shapes):
        return 0
    b = np.array([r["v"] for r in right.orderBy(u("key", "pivot"), "key").limit(SAMPLE_RIGHT).collect()])
    a = np.array([r["v"] for r in left.orderBy(u("key", "pivot"), "key").limit(SAMPLE_LEFT).collect()])
    if grouped:
        a, b = a[:, :-1], b[:, :-1]
    costs = {0: plain}
    for count in PIVOTS:
        if count > len(b):
            break
        to_left, to_right = distances(a, b[:count], p), np.sort(distances(b, b[:count], p), axis=0)
        cell = to_left.argmin(axis=1)
        kth = to_right[min(len(b) - 1, math.ceil(want * len(b) / m))]  # where the want-th smallest of all would lie
        compared = 0.0
        for c, rows in zip(*np.unique(cell, return_counts=True)):
            reach = 2 * to_left[cell == c, c].max() + kth[c]
            compared += rows / len(a) * np.searchsorted(to_right[:, c], reach, side="right") / len(b)
        costs[count] = plain * compared + 2 * count * (n + m) + PIVOT_PASSES / max(width, 1)
    return min(costs, key=lambda c: (costs[c], c))


def _pivot_join(
    left: DataFrame, right: DataFrame, match: Callable, schema: str, want: int, p: float, pivots: int, block_rows: int, grouped: bool = False,
) -> DataFrame:
    """Match each left row with all right rows that can be among its ``want`` nearest, and few others.

    ``grouped`` vectors end in a group; then a bound counts the ``want`` nearest right rows outside each group.

    With pivot distances: a left cell of radius U has a neighbour within U + |p_i y| for every right row y, so the
    ``want``-th smallest of these, theta, bounds the neighbours of the whole cell. A right row farther than U + theta from
    the pivot of the cell cannot be one.
    """
    centres = np.array([r["v"] for r in right.orderBy(u("key", "pivot"), "key").limit(pivots).collect()])
    if not len(centres):
        return block_join(left, right, match, schema, block_rows)
    count = len(centres)
    centres = centres[:, :-1] if grouped else centres
    to_centres = lambda v: distances(v[:, :-1] if grouped else v, centres, p)

    @F.pandas_udf("cell int, gap double")
    def locate(v: pd.Series) -> pd.DataFrame:
        if not len(v):
            return pd.DataFrame({"cell": [], "gap": []})
        dist = to_centres(np.stack(v.to_numpy()))
        return pd.DataFrame({"cell": dist.argmin(axis=1), "gap": dist.min(axis=1)})

    def lowest(batches):
        kept: dict[float, np.ndarray] = {}
        for batch in batches:
            if len(batch):
                v = np.stack(batch["v"].to_numpy())
                dist, group = to_centres(v), v[:, -1] if grouped else np.zeros(len(v))
                for g in np.unique(group).tolist():
                    kept[g] = np.sort(np.vstack([kept.get(g, np.empty((0, count))), dist[group == g]]), axis=0)[:want]
        for g, least in kept.items():
            rank, cell = np.divmod(np.arange(least.size), count)
            yield pd.DataFrame({"cell": cell, "part": g, "gap": least[rank, cell]})

    left_side = written(left.withColumn("at", locate("v")).select("key", "v", "at.cell", "at.gap"))
    left_rows, radius = [0] * count, [0.0] * count
    for r in left_side.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("u")).collect():
        left_rows[r["cell"]], radius[r["cell"]] = r["n"], r["u"]
    # A task hands on its ``want`` smallest distances to every pivot, so the window sees a few rows per task and pivot.
    order = Window.partitionBy("cell", "part").orderBy("gap")
    partial = right.select("v").mapInPandas(lowest, "cell int, part double, gap double").withColumn("r", F.row_number().over(order))
    nearest: dict[int, list] = {}
    for r in partial.filter(F.col("r") <= want).collect():
        nearest.setdefault(r["cell"], []).append((r["gap"], r["part"]))
    theta = [float("inf")] * count
    for cell, gaps in nearest.items():
        bounds = []
        for group in {g for _, g in gaps} if grouped else {None}:
            outside = sorted(gap for gap, g in gaps if g != group)
            bounds.append(outside[want - 1] if len(outside) >= want else float("inf"))
        theta[cell] = radius[cell] + max(bounds)
    # A little slack keeps rounding from cutting off a row on the boundary.
    reach = [(radius[i] + theta[i]) * (1 + 1e-9) + 1e-9 if left_rows[i] else -1.0 for i in range(count)]

    @F.pandas_udf("array<int>")
    def within_reach(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        near = to_centres(np.stack(v.to_numpy())) <= np.array(reach)
        return pd.Series([np.flatnonzero(row).astype(np.int32) for row in near])

    sent = right.select("key", "v", F.explode(within_reach("v")).alias("cell"))
    right_rows = [0] * count
    for r in sent.groupBy("cell").count().collect():
        right_rows[r["cell"]] = r["count"]
    return _join_cells(left_side.select("key", "v", "cell"), sent, left_rows, right_rows, match, schema, block_rows)


class Cells:
    """A k-d tree of bounded size whose 2 ** depth leaves are cells; ``seal`` adds what the cells hold.

    Inner nodes are numbered like a heap from 0; the leaves follow them. A row goes right when its coordinate is above the cut.
    """

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, inner = depth, 2**depth - 1
        self.axis, self.cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        rows = {0: np.arange(len(sample))}
        for node in range(inner):
            own = rows.pop(node)
            spread = np.ptp(sample[own], axis=0) if len(own) > 1 else np.zeros(1)
            if spread.max() > 0:
                axis = int(spread.argmax())
                values = sample[own, axis]
                middle = np.partition(values, (len(own) - 1) // 2)[(len(own) - 1) // 2]
                self.axis[node], self.cut[node] = axis, middle if middle < values.max() else values[values < middle].max()
            right = sample[own, self.axis[node]] > self.cut[node]
            rows[2 * node + 1], rows[2 * node + 2] = own[~right], own[right]

    def locate(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.axis[node]] > self.cut[node])
        return node - len(self.axis)

    def seal(self, sizes: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Rows that each cell holds for any left row, and the boxes around all rows of the cells; empty boxes are inverted."""
        inner = len(self.axis)
        self.sizes = sizes
        self.low, self.high = (np.vstack([np.empty((inner, low.shape[1])), box]) for box in (low, high))
        for node in range(inner - 1, -1, -1):
            self.low[node] = np.minimum(self.low[2 * node + 1], self.low[2 * node + 2])
            self.high[node] = np.maximum(self.high[2 * node + 1], self.high[2 * node + 2])

    def farthest(self, x: np.ndarray, want: int, p: float) -> np.ndarray:
        """A distance within which each row surely has ``want`` rows, by the far corners of the boxes."""
        low, high = self.low[len(self.axis):], self.high[len(self.axis):]
        full = np.flatnonzero(self.sizes > 0)
        out = np.full(len(x), np.inf)
        if self.sizes.sum() >= want:
            for i, row in enumerate(x):
                gap = np.maximum(np.abs(row - low[full]), np.abs(row - high[full]))
                far = (gap**p).sum(axis=1) ** (1.0 / p)
                by = np.argsort(far)
                out[i] = far[by[np.searchsorted(np.cumsum(self.sizes[full[by]]), want)]]
        return out

    def within(self, x: np.ndarray, reach: np.ndarray, p: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a row and a cell whose box is within reach of the row. A little slack keeps rounding from losing one."""
        limit = reach * (1 + 1e-9)
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for level in range(self.depth + 1):
            if level:
                if 2 * len(row) * x.shape[1] > MATRIX_CELLS and len(x) > 1:
                    half = len(x) // 2
                    (r1, c1), (r2, c2) = self.within(x[:half], reach[:half], p), self.within(x[half:], reach[half:], p)
                    return np.concatenate([r1, half + r2]), np.concatenate([c1, c2])
                row, node = np.repeat(row, 2), np.stack([2 * node + 1, 2 * node + 2], axis=1).ravel()
            at = x[row]
            gap = np.maximum(np.maximum(self.low[node] - at, at - self.high[node]), 0.0)
            near = (gap**p).sum(axis=1) ** (1.0 / p) * (1 - 1e-9) <= limit[row]
            near &= np.isfinite(self.low[node, 0])
            row, node = row[near], node[near]
        return row, node - len(self.axis)


def _cell_join(
    left: DataFrame, right: DataFrame, match: Callable, schema: str, k: int, want: int, p: float, shapes: tuple, block_rows: int, grouped: bool = False,
) -> DataFrame | None:
    """Match each left row with the right rows of its own cell, then of the cells within reach of its k-th neighbour so far.

    Every right row lies in one cell; only left rows are sent to several. None if a coordinate is no
    number or too large.
    """
    (n, width), (m, _) = shapes
    width -= grouped
    depth = max(1, math.ceil(math.log2(min(MOST_CELLS, max(2.0, m / CELL_ROWS)))))
    some = CELL_SAMPLE * 2**depth
    if some < m:  # rows that repeat their key are told apart by their vectors
        drawn = right.filter(F.pmod(F.xxhash64("key", "v", F.lit("cells")), F.lit(1 << 30)) < int((1 << 30) * some / m)).limit(2 * some)
    else:
        drawn = right
    sample = np.array([r["v"][:width] for r in drawn.select("v").collect()]).reshape(-1, width)
    cells = Cells(sample[np.isfinite(sample).all(axis=1)], depth)

    @F.pandas_udf("int")
    def locate(v: pd.Series) -> pd.Series:
        return pd.Series(cells.locate(np.stack(v.to_numpy())) if len(v) else [], dtype="int32")

    left_side, right_side = (written(side.withColumn("cell", locate("v"))) for side in (left, right))
    at = [F.col("v")[j] for j in range(width)]
    most = 1e299 ** (1.0 / max(p, 2.0))  # larger coordinates have no distance
    odd = lambda side: side.filter(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > most)))
    if not odd(left_side).isEmpty() or not odd(right_side).isEmpty():
        return None
    group = F.col("v")[width] if grouped else F.lit(0)
    parts = right_side.groupBy("cell", group.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{s}{j}") for j, c in enumerate(at) for s, f in (("a", F.min), ("b", F.max))]
    )
    boxes = parts.groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), *[f(f"{s}{j}").alias(f"{s}{j}") for j in range(width) for s, f in (("a", F.min), ("b", F.max))]
    )
    count = 2**depth
    left_rows, right_rows, sizes = [0] * count, [0] * count, np.zeros(count, np.int64)
    low, high = np.full((count, width), np.inf), np.full((count, width), -np.inf)
    for r in boxes.collect():
        right_rows[r["cell"]], sizes[r["cell"]] = r["n"], r["n"] - (r["most"] if grouped else 0)
        low[r["cell"]], high[r["cell"]] = [r[f"a{j}"] for j in range(width)], [r[f"b{j}"] for j in range(width)]
    for r in left_side.groupBy("cell").count().collect():
        left_rows[r["cell"]] = r["count"]
    cells.seal(sizes, low, high)
    tasks = lambda rows: min(MOST_TASKS, max(TASKS_A_UNIT * parallelism(left.sparkSession), math.ceil((rows + m) / CELL_TASK_ROWS)))
    order = Window.partitionBy("l").orderBy("distance", "r")
    home = _join_cells(left_side, right_side, left_rows, right_rows, match, schema, block_rows, tasks(n))
    home = written(home.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k))
    bounds = home.filter(F.col("place") == k).select(F.col("l").alias("own"), F.col("distance").alias("reach"))

    @F.pandas_udf("array<int>")
    def others(v: pd.Series, reach: pd.Series, cell: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(v), TREE_ROWS):
            x, own = np.stack(v.to_numpy()[start:start + TREE_ROWS])[:, :width], cell.to_numpy()[start:start + TREE_ROWS]
            far = reach.to_numpy(dtype=float, copy=True)[start:start + TREE_ROWS]
            open_ = np.isnan(far)
            far[open_] = cells.farthest(x[open_], want, p)
            row, found = cells.within(x, far, p)
            row, found = row[found != own[row]], found[found != own[row]]
            by = np.argsort(row, kind="stable")
            out += np.split(found[by].astype(np.int32), np.searchsorted(row[by], np.arange(1, len(x))))
        return pd.Series(out, dtype=object)

    bounded = left_side.join(bounds, F.col("key").eqNullSafe(F.col("own")), "left")
    sent = written(bounded.select("key", "v", F.explode(others("v", "reach", "cell")).alias("cell")))
    sent_rows = [0] * count
    for r in sent.groupBy("cell").count().collect():
        sent_rows[r["cell"]] = r["count"]
    if not any(sent_rows):
        return home.drop("place")
    away = _join_cells(sent, right_side, sent_rows, right_rows, match, schema, block_rows, tasks(sum(sent_rows)))
    return home.drop("place").unionByName(away)


def distances(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """Minkowski distances between the rows of two blocks, accumulated coordinate by coordinate."""
    out = np.zeros((len(a), len(b)))
    _add_powers(a, np.ascontiguousarray(b.T), out, lambda gap: gap if p == 1 else np.multiply(gap, gap, out=gap) if p == 2 else np.power(gap, p, out=gap))
    return out if p == 1 else np.sqrt(out) if p == 2 else out ** (1.0 / p)


def _add_powers(a: np.ndarray, columns: np.ndarray, out: np.ndarray, power: Callable) -> None:
    """Adds the powers of the coordinate gaps between the rows of ``a`` and of ``columns`` (width x rows) to ``out``, part by part."""
    wide = min(out.shape[1], CACHED_CELLS)
    tall = max(1, CACHED_CELLS // max(wide, 1))
    if wide * tall < CACHED_CELLS // 2 or tall < 16:
        wide, tall = min(wide, CACHED_CELLS // 16), 16
    for top in range(0, out.shape[0], tall):
        for at in range(0, out.shape[1], max(wide, 1)):
            part = out[top:top + tall, at:at + wide]
            gap = np.empty(part.shape, out.dtype)
            for j in range(len(columns)):
                np.subtract(a[top:top + tall, j, None], columns[j, at:at + wide], out=gap)
                np.add(part, power(np.abs(gap, out=gap)), out=part)


def rough_mask(a: np.ndarray, b: np.ndarray, k: int, p: int) -> np.ndarray | None:
    """Rows of ``b`` that can be among the k neighbours for a whole ``p``, from single precision with a safe error margin.

    Rounding moves a gap by a share of its coordinates, and a norm by at most the sum of these moves. None if the numbers are
    too large or not finite.
    """
    width, centre = a.shape[1], b.mean(axis=0)
    a, b = a - centre, b - centre
    largest = max(np.abs(a).max(), np.abs(b).max())
    if not (2.0 * largest + 1.0) ** p * width < 1e37:
        return None
    out = np.zeros((len(a), len(b)), np.float32)

    def power(gap: np.ndarray) -> np.ndarray:
        once = gap.copy() if p > 2 else gap
        for _ in range(p - 1):
            gap = np.multiply(gap, once, out=gap)
        return gap

    _add_powers(a.astype(np.float32), np.ascontiguousarray(b.T).astype(np.float32), out, power)
    kth = np.partition(out, k - 1, axis=1)[:, k - 1].astype(float)
    margin = (width + p + 8) * 1.2e-7 * (np.abs(a).sum(axis=1) + np.abs(b).sum(axis=1).max()) + (width * 1e-37) ** (1.0 / p)
    limit = (kth ** (1.0 / p) + 2.0 * margin) ** p * (1 + 1e-5)
    return out <= np.nextafter(limit.astype(np.float32), np.float32(np.inf))[:, None]


def candidate_mask(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Rows of ``b`` that can be among the k Euclidean neighbours, from one matrix product with a safe error margin."""
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    square = aa[:, None] + bb[None, :] - 2.0 * (a @ b.T)
    kth = np.partition(square, k - 1, axis=1)[:, k - 1]
    margin = 1e-10 * (1.0 + aa + bb.max())
    return square <= (kth + margin)[:, None]


def pair_distances(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray, p: float) -> np.ndarray:
    """Minkowski distances of the pairs (row of a, col of b), accumulated coordinate by coordinate."""
    out = np.zeros(len(row))
    for j in range(a.shape[1]):
        gap = np.abs(a[row, j] - b[col, j])
        out += gap if p == 1 else gap * gap if p == 2 else gap**p
    return out if p == 1 else np.sqrt(out) if p == 2 else out ** (1.0 / p)


def key_order(keys: np.ndarray) -> np.ndarray:
    """Place of each key among the sorted keys."""
    place = np.empty(len(keys), np.int64)
    place[np.argsort(keys.astype(str) if keys.dtype == object else keys, kind="stable")] = np.arange(len(keys))
    return place


def best_of_rows(row: np.ndarray, dist: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Positions of the pairs that are among the k nearest of their row; ties by ``place``."""
    by = np.lexsort((place, dist, row))
    first = np.flatnonzero(np.diff(row[by], prepend=-1))
    rank = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
    return by[rank < k]


def nearest_pairs(a: np.ndarray, b: np.ndarray, place: np.ndarray, k: int, p: float, differ: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of a, row of b and distance of the k nearest rows of b for every row of a.

    ``differ(row, col)`` tells which pairs count at all; then one more neighbour is looked for. Narrow vectors are compared leaf by leaf.
    """
    if a.shape[1] <= LEAF_WIDTH and len(b) > 2 * LEAF_RIGHT and len(a) * len(b) > LEAF_PAIRS and np.isfinite(a).all() and np.isfinite(b).all():
        return _nearest_in_leaves(a, b, place, k, p, differ)
    return _nearest_of_all(a, b, place, k, p, differ)


def _nearest_of_all(a: np.ndarray, b: np.ndarray, place: np.ndarray, k: int, p: float, differ: Callable | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    want = k + (differ is not None)
    out = []
    step = max(1, MATRIX_CELLS // len(b))
    for start in range(0, len(a), step):
        part = a[start:start + step]
        mask = None
        if len(b) > 4 * want and p == 2:
            mask = candidate_mask(part, b, want)
        elif len(b) > 4 * want and p in (1, 3, 4):
            mask = rough_mask(part, b, want, int(p))
        if mask is not None:
            row, col = np.nonzero(mask)
            dist = pair_distances(part, b, row, col, p)
        else:
            whole = distances(part, b, p)
            near = whole <= np.partition(whole, want - 1, axis=1)[:, want - 1, None] if len(b) > want else np.ones(whole.shape, bool)
            row, col = np.nonzero(near)
            dist = whole[row, col]
        if differ is not None:
            other = differ(start + row, col)
            row, col, dist = row[other], col[other], dist[other]
        best = best_of_rows(row, dist, place[col], k)
        out.append((start + row[best], col[best], dist[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def leaves(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows in groups of at most ``most`` that lie together: halved at the median of the widest coordinate. Equal rows stay together."""
    out, rest = [], [np.arange(len(x))]
    while rest:
        rows = rest.pop()
        spread = np.ptp(x[rows], axis=0) if len(rows) > most else np.zeros(1)
        if not spread.max() > 0:
            out.append(rows)
            continue
        middle = len(rows) // 2
        by = np.argpartition(x[rows, spread.argmax()], middle)
        rest += [rows[by[:middle]], rows[by[middle:]]]
    return out


def _nearest_in_leaves(a: np.ndarray, b: np.ndarray, place: np.ndarray, k: int, p: float, differ: Callable | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A leaf of left rows meets the right leaves whose boxes are within reach: the ``want``-th distance found in the closest ones."""
    want = k + (differ is not None)
    right = leaves(b, LEAF_RIGHT)
    order = np.concatenate(right)
    sizes = np.array([len(r) for r in right])
    begin = np.cumsum(sizes) - sizes
    b, place = b[order], place[order]
    low, high = np.minimum.reduceat(b, begin, axis=0), np.maximum.reduceat(b, begin, axis=0)

    def rows_of(chosen: np.ndarray) -> np.ndarray:
        chosen = np.sort(chosen)
        return np.arange(sizes[chosen].sum()) + np.repeat(begin[chosen] - (np.cumsum(sizes[chosen]) - sizes[chosen]), sizes[chosen])

    out = []
    for rows in leaves(a, LEAF_LEFT):
        part = a[rows]
        gap = np.maximum(np.maximum(low - part.max(axis=0), part.min(axis=0) - high), 0.0)
        bound = (gap**p).sum(axis=1) ** (1.0 / p)
        by = np.argsort(bound, kind="stable")
        enough = int(np.searchsorted(np.cumsum(sizes[by]), min(want, len(b)))) + 1
        first = b[rows_of(by[:enough])][: 8 * LEAF_RIGHT]
        reach = np.inf
        if len(first) >= want:
            some = distances(part[:MATRIX_CELLS // len(first)], first, p)
            if len(some) == len(part):
                reach = np.partition(some, want - 1, axis=1)[:, want - 1].max() * (1 + 1e-9)
        cols = rows_of(np.flatnonzero(bound * (1 - 1e-9) <= reach))
        own = (lambda row, col, rows=rows, cols=cols: differ(rows[row], order[cols[col]])) if differ is not None else None
        row, col, dist = _nearest_of_all(part, b[cols], place[cols], k, p, own)
        out.append((rows[row], order[cols[col]], dist))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sides(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_vec: str, right_vec: str, apart: str | None = None) -> tuple[DataFrame, DataFrame, str]:
    """Keys and vectors of both sides; the value of ``apart`` follows the coordinates."""
    vector = lambda c: F.col(c).cast("array<double>") if apart is None else F.concat(F.col(c).cast("array<double>"), F.array(F.col(apart).cast("double")))
    lhs = left.select(F.col(left_key).alias("key"), vector(left_vec).alias("v"))
    rhs = right.select(F.col(right_key).alias("key"), vector(right_vec).alias("v"))
    kind = {side: frame.schema["key"].dataType.simpleString() for side, frame in (("l", lhs), ("r", rhs))}
    return lhs, rhs, f"l {kind['l']}, r {kind['r']}, distance double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("l").orderBy("distance", "r")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("l").alias("left_key"), F.col("r").alias("right_key"), "distance", "rank")


def knn_join(
    left: DataFrame, right: DataFrame, k: int, left_key: str, right_key: str, left_vec: str = "vec",
    right_vec: str = "vec", p: float = 2.0, exclude_self: bool = False, pivots: int | None = None, block_rows: int = BLOCK_ROWS,
    apart: str | None = None,
) -> DataFrame:
    """The k nearest right rows of every left row: ``left_key, right_key, distance, rank``; ties by right key.

    ``p`` is 1 (Manhattan), 2 (Euclidean) or any Minkowski order from 1 on. ``exclude_self`` skips equal keys. ``pivots`` is
    the number of pivot rows used to skip pairs that are too far apart; 0 compares all pairs, None lets a sample decide, and
    narrow vectors are then joined by cells instead.
    ``apart`` names a column of small numbers, such as folds: rows with equal values are no neighbours.
    """
    lhs, rhs, schema = _sides(left, right, left_key, right_key, left_vec, right_vec, apart)
    want = k + 1 if exclude_self else k

    def nearest(left_keys, a, right_keys, b):
        differ = (lambda row, col: left_keys[row] != right_keys[col]) if exclude_self else None
        place = key_order(right_keys)
        if apart is None:
            row, col, dist = nearest_pairs(a, b, place, k, p, differ)
            return left_keys[row], right_keys[col], dist
        out = []
        for group in np.unique(a[:, -1]):
            mine, other = np.flatnonzero(a[:, -1] == group), np.flatnonzero(b[:, -1] != group)
            if len(other):
                own = (lambda row, col: left_keys[mine[row]] != right_keys[other[col]]) if exclude_self else None
                row, col, dist = nearest_pairs(a[mine, :-1], b[other, :-1], place[other], k, p, own)
                out.append((left_keys[mine[row]], right_keys[other[col]], dist))
        return [np.concatenate(x) for x in zip(*out)] if out else [[]] * 3

    shapes = _shape(lhs), _shape(rhs)
    rows, found = _rows_of(block_rows, shapes[0][1]), None
    if pivots is None and shapes[0][1] - (apart is not None) <= CELL_WIDTH and _many(shapes):
        found = _cell_join(lhs, rhs, nearest, schema, k, want, p, shapes, rows, apart is not None)
    if found is None and pivots is None:
        pivots = pivot_count(lhs, rhs, shapes, want, p, apart is not None)
    if found is not None:
        pass
    elif pivots:
        found = _pivot_join(lhs, rhs, nearest, schema, want, p, pivots, rows, apart is not None)
    else:
        one = F.lit(0).alias("cell")
        found = _join_cells(lhs.select("key", "v", one), rhs.select("key", "v", one), [shapes[0][0]], [shapes[1][0]], nearest, schema, rows)
    return _ranked(found, k)


def collision(distance: np.ndarray, width: float) -> np.ndarray:
    """Chance that two vectors fall into one slot of a random projection with slots of ``width``."""
    t = np.minimum(width / np.maximum(distance, 1e-300), 1e6)
    below = np.array([0.5 * math.erfc(x / math.sqrt(2.0)) for x in np.minimum(t, 40.0).ravel()]).reshape(t.shape)
    return np.where(distance <= 0, 1.0, np.clip(1.0 - 2.0 * below - 2.0 / (math.sqrt(2.0 * math.pi) * t) * (1.0 - np.exp(-np.minimum(t * t, 1_000.0) / 2.0)), 0.0, 1.0))


def lsh_plan(near: np.ndarray, apart: np.ndarray, recall: float) -> tuple[float, int, int]:
    """Slot width, projections of a table and tables that need the fewest comparisons for the wanted recall.

    ``near`` holds distances of true neighbours, ``apart`` those of any two rows. A neighbour at distance c is found with a
    chance of 1 - (1 - p(c)^m)^L, where p is the collision chance; any other row is compared L p^m times.
    """
    middle = max(float(np.median(near)), 1e-12)
    best = None
    for factor in (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0):
        hit, miss = collision(near, factor * middle), collision(apart, factor * middle)
        for m in range(1, 33):
            once = hit**m
            for tables in (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64):
                if (1.0 - (1.0 - once) ** tables).mean() >= recall:
                    cost = tables * ((miss**m).mean() + 1e-4)
                    if best is None or cost < best[0]:
                        best = (cost, factor * middle, m, tables)
                    break
    return best[1:] if best else (16.0 * middle, 1, 8)


def knn_join_lsh(
    left: DataFrame, right: DataFrame, k: int, left_key: str, right_key: str, left_vec: str = "vec", right_vec: str = "vec",
    recall: float = 0.97, sample: int = SAMPLE_LEFT, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """About the k nearest right rows (Euclidean) of every left row: ``left_key, right_key, distance, rank``.

    ``recall`` is the share of true neighbours that the hash tables are laid out to find, from the exact neighbours of
    ``sample`` left rows. Every right row is in every table. Distances are exact; buckets of any size are compared whole, in
    blocks. Left rows with fewer than k candidates are joined exactly, so that every left row gets its k rows.
    """
    lhs, rhs, schema = _sides(left, right, left_key, right_key, left_vec, right_vec)
    lhs, rhs = written(lhs), written(rhs)
    few = lhs.orderBy(u("key", "lsh"), "key").limit(sample)
    known = knn_join(few, rhs, k, "key", "key", "v", "v", pivots=0)
    near = np.array([r["distance"] for r in known.select("distance").collect()])
    some = [np.array([r["v"] for r in side.orderBy(u("key", "apart"), "key").limit(sample).collect()]) for side in (lhs, rhs)]
    if not len(near):
        return _ranked(lhs.sparkSession.createDataFrame([], schema), k)
    width, projections, tables = lsh_plan(near, distances(*some, 2.0).ravel(), recall)
    random = np.random.Generator(np.random.PCG64(20_240_607))
    axes = random.standard_normal((some[1].shape[1], projections * tables))
    shift = random.uniform(0.0, width, projections * tables)
    mixer = random.integers(1, 2**62, projections, dtype=np.int64) * 2 + 1

    @F.pandas_udf("array<bigint>")
    def buckets(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        slots = np.floor((np.stack(v.to_numpy()) @ axes + shift) / width).astype(np.int64)
        return pd.Series(list((slots.reshape(len(v), tables, projections) * mixer).sum(axis=2)))

    def placed(df: DataFrame) -> DataFrame:
        return df.select("key", "v", F.posexplode(buckets("v")).alias("table", "slot")).select("key", "v", F.xxhash64("table", "slot").alias("cell"))

    rows = _rows_of(block_rows, some[1].shape[1])
    found = written(_join_hashed_cells(written(placed(lhs)), written(placed(rhs)), k, schema, rows).distinct())
    full = found.groupBy("l").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select(F.col("l").alias("key"))
    rest = lhs.join(full, "key", "left_anti")
    exact = knn_join(rest, rhs, k, "key", "key", "v", "v").select(F.col("left_key").alias("l"), F.col("right_key").alias("r"), "distance")
    return _ranked(found.join(rest.select(F.col("key").alias("l")), "l", "left_anti").unionByName(exact), k)


def _join_hashed_cells(left: DataFrame, right: DataFrame, k: int, schema: str, block_rows: int) -> DataFrame:
    """The k nearest right rows of each left row in each cell; the many small cells of a task are compared at once.

    Both sides have ``key, v, cell``. A cell with more than ``block_rows`` rows on a side is cut by a hash of the row key.
    """
    counts = [side.groupBy("cell").agg(F.count(F.lit(1)).alias(n)) for side, n in ((left, "nl"), (right, "nr"))]
    both = counts[0].join(counts[1], "cell").withColumns({"al": F.col("nl"), "ar": F.col("nr")})
    both = written(both.withColumns({n: F.ceil(F.col(n) / block_rows).cast("int") for n in ("nl", "nr")}))
    heavy = both.filter("nl > 1 or nr > 1").select("cell", "nl", "nr")
    moved = both.agg(F.coalesce(F.sum(F.col("al") * F.col("nr") + F.col("ar") * F.col("nl")), F.lit(0))).first()[0]
    groups = max(parallelism(left.sparkSession), math.ceil(moved / block_rows))
    tasks = min(MOST_TASKS, TASKS_A_UNIT * groups)

    def cut(side: DataFrame, own: str, other: str, salt: str) -> DataFrame:
        df = attach(side, heavy, ["cell"]).withColumns({n: F.coalesce(n, F.lit(1)) for n in ("nl", "nr")})
        mine = F.pmod(F.xxhash64("key", F.lit(salt)), F.col(own)).cast("int")
        df = df.select("key", "v", "cell", mine.alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other))
        return df.select(F.col("key"), "v", F.xxhash64("cell", "nl", "nr").alias("unit")).withColumn("g", F.pmod("unit", F.lit(groups)))

    names = [part.split()[0] for part in schema.split(",")]

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return _frame(names, [[]] * len(names))
        a, b = a.sort_values("unit", kind="stable"), b.sort_values("unit", kind="stable")
        left_keys, right_keys, x, y = a["key"].to_numpy(), b["key"].to_numpy(), np.stack(a["v"].to_numpy()), np.stack(b["v"].to_numpy())
        place, units, begin = key_order(right_keys), b["unit"].to_numpy(), a["unit"].to_numpy()
        low, high = np.searchsorted(units, begin, "left"), np.searchsorted(units, begin, "right")
        out = []
        edges = np.flatnonzero(np.diff(begin, prepend=begin[0] - 1 if begin[0] > 0 else begin[0] + 1))
        full = np.zeros(len(x), bool)
        for at, end in zip(edges.tolist(), np.append(edges[1:], len(x)).tolist()):  # many pairs of one bucket: a matrix product
            if (end - at) * int(high[at] - low[at]) > BUCKET_PAIRS:
                full[at:end] = True
                row, col, dist = nearest_pairs(x[at:end], y[low[at]:high[at]], place[low[at]:high[at]], k, 2.0)
                out.append((left_keys[at + row], right_keys[low[at] + col], dist))
        left_keys, x, low, high = left_keys[~full], x[~full], low[~full], high[~full]
        upto = np.cumsum(high - low)
        start = 0
        while start < len(x):  # left rows whose pairs fit in memory together, one at least
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + MATRIX_CELLS, side="right")))
            sizes = (high - low)[start:stop]
            row = np.repeat(np.arange(start, stop), sizes)
            col = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[row]
            dist = pair_distances(x, y, row, col, 2.0)
            best = best_of_rows(row, dist, place[col], k)
            out.append((left_keys[row[best]], right_keys[col[best]], dist[best]))
            start = stop
        return _frame(names, [np.concatenate(c) for c in zip(*out)])

    lhs, rhs = cut(left, "nl", "nr", "l"), cut(right, "nr", "nl", "r")
    if moved > SPREAD_ROWS:
        lhs, rhs = lhs.repartition(tasks, "g"), rhs.repartition(tasks, "g")
    return lhs.groupBy("g").cogroup(rhs.groupBy("g")).applyInPandas(compare, schema)


def knn_classify(
    train: DataFrame, test: DataFrame, k: int, key: str, label: str, vec: str = "vec", p: float = 2.0,
    weights: str = "uniform", pivots: int | None = None,
) -> DataFrame:
    """Vote of the k nearest training rows: ``key, score, prediction`` for a 0/1 label; ``pivots`` as in ``knn_join``.

    With ``weights="distance"`` a vote counts 1 / distance, and only exact matches count when there are any. Half of
    the vote is not enough for class 1.
    """
    pairs = knn_join(test, train, k, key, key, vec, vec, p, pivots=pivots)
    labels = train.select(F.col(key).alias("right_key"), F.col(label).cast("double").alias("y"))
    voted = pairs.join(labels, "right_key")
    if weights == "distance":
        exact = F.sum(F.when(F.col("distance") == 0, 1.0).otherwise(0.0))
        share = F.when(
            exact > 0, F.sum(F.when(F.col("distance") == 0, F.col("y")).otherwise(0.0)) / exact
        ).otherwise(
            F.sum(F.when(F.col("distance") > 0, F.col("y") / F.col("distance")))
            / F.sum(F.when(F.col("distance") > 0, 1.0 / F.col("distance")))
        )
    else:
        share = F.avg("y")
    scored = voted.groupBy(F.col("left_key").alias(key)).agg(share.alias("score"))
    return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))
