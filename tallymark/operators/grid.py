"""Operators on long grids ``(grid, x, y, v)`` that treat many grids at once.

Neighbourhood operators cut every grid into square tiles. A cell is sent to its own tile and, near an edge, to the
tiles next to it, so a tile sees all cells it needs. That moves each cell little more than once, whatever the size of
the kernel, and a huge grid is many bounded units of work.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import attach

LEVELS = 256
TILE = 128

# Kernels of the neighbourhood operators and the luma weights.
GAUSSIAN_5 = np.outer([1, 4, 6, 4, 1], [1, 4, 6, 4, 1]) / 256.0
LAPLACIAN = np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], dtype=float)
SOBEL_X = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]], dtype=float)
SHARPEN = np.array([[-1, -1, -1], [-1, 9, -1], [-1, -1, -1]], dtype=float)
LUMA = {"r": 0.299, "g": 0.587, "b": 0.114}


def gabor_kernel(size: int = 31, sigma: float = 5.0, theta: float = np.pi / 4, wave: float = 10.0, aspect: float = 0.5) -> np.ndarray:
    """Cosine wave of length ``wave`` across the direction ``theta`` under a Gaussian window."""
    half = size // 2
    y, x = np.mgrid[-half:half + 1, -half:half + 1]
    along, across = x * np.cos(theta) + y * np.sin(theta), -x * np.sin(theta) + y * np.cos(theta)
    window = np.exp(-0.5 * (along**2 + (aspect * across) ** 2) / sigma**2)
    return window * np.cos(2 * np.pi * along / wave)


def _sides(position: str, radius: int) -> Column:
    """Numbers of the tiles along one axis that need the cell."""
    first = F.floor((F.col(position) - radius) / TILE)
    last = F.floor((F.col(position) + radius) / TILE)
    return F.explode(F.sequence(F.greatest(first, F.lit(0)), last))


def by_neighbourhood(df: DataFrame, radius: int, compute: Callable, border: str = "reflect") -> DataFrame:
    """Replace ``v`` by ``compute(padded)`` per tile; ``padded`` is a matrix [y, x] with ``radius`` cells around the tile.

    ``border`` fills the outside of a grid: mirrored without repeating the edge, or the edge repeated. Missing cells
    count as 0; a grid reaches from its smallest to its largest x and y.
    """
    if radius >= TILE:
        raise ValueError(f"radius must stay below {TILE}")
    size = lambda c: (F.max(c) - F.min(c) + 1).cast("int")
    extent = df.groupBy("grid").agg(F.min("x").alias("x_first"), F.min("y").alias("y_first"), size("x").alias("w"), size("y").alias("h"))
    placed = attach(df.select("grid", "x", "y", F.col("v").cast("double").alias("v")), extent, ["grid"])
    placed = placed.withColumns({"x": F.col("x") - F.col("x_first"), "y": F.col("y") - F.col("y_first")})
    placed = placed.select("*", _sides("x", radius).alias("tx")).select("*", _sides("y", radius).alias("ty"))
    sized = placed.filter("tx * {0} < w and ty * {0} < h".format(TILE))
    kind = df.schema["grid"].dataType.simpleString()

    def tile(cells: pd.DataFrame) -> pd.DataFrame:
        w, h = int(cells["w"].iloc[0]), int(cells["h"].iloc[0])
        x0, y0 = int(cells["tx"].iloc[0]) * TILE, int(cells["ty"].iloc[0]) * TILE
        x1, y1 = min(x0 + TILE, w), min(y0 + TILE, h)
        left, top = max(x0 - radius, 0), max(y0 - radius, 0)
        right, bottom = min(x1 + radius, w), min(y1 + radius, h)
        known = np.zeros((bottom - top, right - left))
        known[cells["y"].to_numpy() - top, cells["x"].to_numpy() - left] = cells["v"].to_numpy()
        pad = [(radius - (y0 - top), radius - (bottom - y1)), (radius - (x0 - left), radius - (right - x1))]
        out = compute(np.pad(known, pad, mode=border))
        y, x = np.mgrid[y0:y1, x0:x1]
        x, y = x + int(cells["x_first"].iloc[0]), y + int(cells["y_first"].iloc[0])
        return pd.DataFrame({"grid": cells["grid"].iloc[0], "x": x.ravel(), "y": y.ravel(), "v": out.ravel()})

    return sized.groupBy("grid", "tx", "ty").applyInPandas(tile, f"grid {kind}, x int, y int, v double")


def correlate(padded: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Sum of kernel times neighbourhood for every cell inside the padding."""
    height, width = padded.shape[0] - kernel.shape[0] + 1, padded.shape[1] - kernel.shape[1] + 1
    out = np.zeros((height, width))
    for (dy, dx), weight in np.ndenumerate(kernel):
        if weight:
            out += weight * padded[dy:dy + height, dx:dx + width]
    return out


def to_level(values: np.ndarray) -> np.ndarray:
    """Nearest whole level in 0..255."""
    return np.clip(np.floor(values + 0.5), 0, LEVELS - 1)


def gaussian_blur(df: DataFrame) -> DataFrame:
    return by_neighbourhood(df, 2, lambda p: to_level(correlate(p, GAUSSIAN_5)))


def laplacian(df: DataFrame) -> DataFrame:
    return by_neighbourhood(df, 1, lambda p: to_level(np.abs(correlate(p, LAPLACIAN))))


def sobel_magnitude(df: DataFrame) -> DataFrame:
    def magnitude(p):
        return to_level(np.hypot(correlate(p, SOBEL_X), correlate(p, SOBEL_X.T)))

    return by_neighbourhood(df, 1, magnitude)


def sharpen(df: DataFrame, strength: float = 1.0) -> DataFrame:
    return by_neighbourhood(df, 1, lambda p: to_level(correlate(p, SHARPEN * strength)))


def high_boost(df: DataFrame, factor: float = 1.5) -> DataFrame:
    """(1 + factor) * v - factor * blurred v, half-way values to the even level."""

    def boost(p):
        blurred = to_level(correlate(p, GAUSSIAN_5))
        return np.clip(np.rint((1 + factor) * p[2:-2, 2:-2] - factor * blurred), 0, LEVELS - 1)

    return by_neighbourhood(df, 2, boost)


def gabor(df: DataFrame, size: int = 31) -> DataFrame:
    kernel = gabor_kernel(size)
    return by_neighbourhood(df, size // 2, lambda p: to_level(correlate(p, kernel)))


def median_filter(df: DataFrame, size: int = 5) -> DataFrame:
    """Median of the size x size neighbourhood with the edge repeated."""

    def median(p):
        windows = np.lib.stride_tricks.sliding_window_view(p, (size, size))
        return np.median(windows, axis=(2, 3))

    return by_neighbourhood(df, size // 2, median, border="edge")


def _level_counts(df: DataFrame) -> DataFrame:
    """At most 256 rows per grid, so the windows over levels are bounded."""
    return df.groupBy("grid", F.col("v").cast("int").alias("v")).agg(F.count(F.lit(1)).alias("n"))


def otsu_threshold(df: DataFrame) -> DataFrame:
    """``grid, threshold``: the level that maximises the variance between the two sides, the smallest on a tie."""
    counts = _level_counts(df)
    upto = Window.partitionBy("grid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("grid")
    mass = F.col("n") * F.col("v")
    sums = counts.select(
        "grid", "v", F.sum("n").over(upto).alias("w0"), F.sum(mass).over(upto).alias("s0"), F.sum("n").over(whole).alias("w"),
        F.sum(mass).over(whole).alias("s"),
    )
    wide = lambda name: F.col(name).cast("decimal(19,0)")  # noqa: E731  products of sums outgrow bigint, ties need them exact
    gap = (wide("s") * wide("w0") - wide("w") * wide("s0")).cast("double")
    between = F.when(F.col("w0") == F.col("w"), F.lit(0.0)).otherwise(gap * gap / (wide("w0") * (wide("w") - wide("w0"))).cast("double"))
    return sums.groupBy("grid").agg(F.min_by("v", F.struct(-between, F.col("v"))).alias("threshold"))


def crop_to_foreground(df: DataFrame, margin: int = 10) -> DataFrame:
    """Crop to the cells above the threshold of the blurred grid, plus a margin; a grid without any stays whole."""
    blurred = gaussian_blur(df)
    above = attach(blurred, otsu_threshold(blurred), ["grid"]).filter(F.col("v") > F.col("threshold"))
    box = above.groupBy("grid").agg(
        (F.min("x") - margin).alias("__x0"), (F.max("x") + margin).alias("__x1"), (F.min("y") - margin).alias("__y0"),
        (F.max("y") + margin).alias("__y1"),
    )
    inside = F.col("x").between(F.col("__x0"), F.col("__x1")) & F.col("y").between(F.col("__y0"), F.col("__y1"))
    return attach(df, box, ["grid"]).filter(inside | F.col("__x0").isNull()).drop("__x0", "__x1", "__y0", "__y1")


def equalize(df: DataFrame) -> DataFrame:
    """Histogram equalisation per grid; a constant grid stays as it is."""
    counts = _level_counts(df)
    upto = Window.partitionBy("grid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("grid")
    table = counts.select(
        "grid", "v", F.sum("n").over(upto).alias("cdf"), F.sum("n").over(whole).alias("cells"),
        F.first("n").over(upto).alias("low"),
    )
    scaled = F.floor((F.col("cdf") - F.col("low")) * 255.0 / (F.col("cells") - F.col("low")) + 0.5).cast("int")
    lookup = table.select(
        "grid", F.col("v").alias("__level"), F.when(F.col("cells") == F.col("low"), F.col("v")).otherwise(scaled).alias("__new")
    )
    keyed = df.withColumn("__level", F.col("v").cast("int"))
    return attach(keyed, lookup, ["grid", "__level"]).withColumn("v", F.col("__new").cast("double")).drop("__new", "__level")


def gamma_curve(df: DataFrame, gamma: float = 1.5) -> DataFrame:
    """Brightness curve on 256 levels, cut to whole levels."""
    return df.withColumn("v", F.floor(F.pow(F.col("v") / 255.0, F.lit(1.0 / gamma)) * 255).cast("double"))


def normalize(df: DataFrame) -> DataFrame:
    """Per-grid min-max to 0..255, cut to whole levels."""
    edges = df.groupBy("grid").agg(F.min("v").alias("__lo"), F.max("v").alias("__hi"))
    scaled = (F.col("v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo") + 1e-8)
    return attach(df, edges, ["grid"]).withColumn("v", F.floor(scaled * 255).cast("double")).drop("__lo", "__hi")


def channel_balance(df: DataFrame) -> DataFrame:
    """Scale each channel of a grid to the mean of the channel means; clip to 0..255 and cut to whole levels."""
    means = df.groupBy("grid", "channel").agg(F.avg("v").alias("__mean"))
    grey = means.groupBy("grid").agg(F.avg("__mean").alias("__grey"))
    joined = attach(attach(df, means, ["grid", "channel"]), grey, ["grid"])
    scaled = F.when(F.col("__mean") == 0, F.col("v")).otherwise(F.col("v") * (F.col("__grey") / F.col("__mean")))
    return joined.withColumn("v", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), scaled))).cast("double")).drop("__mean", "__grey")


def luma(df: DataFrame) -> DataFrame:
    """Weighted sum of the channels r, g and b of every cell, to the nearest level."""
    weight = reduce(lambda w, c: F.when(F.col("channel") == c[0], c[1]).otherwise(w), LUMA.items(), F.lit(0.0))
    return df.groupBy("grid", "x", "y").agg(F.floor(F.sum(F.col("v") * weight) + 0.5).cast("double").alias("v"))
