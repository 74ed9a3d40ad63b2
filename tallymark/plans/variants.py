"""Grid preparation from a configuration: optional steps in a fixed order, several variants over the same grids."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators import grid, scale
from tallymark.session import attach

SEPARATOR = "\x1f"


def per_channel(step: Callable) -> Callable:
    """Run a step of one-channel grids on every channel of a grid by itself."""

    def run(df: DataFrame, argument) -> DataFrame:
        if "channel" not in df.columns:
            return step(df, argument)
        kind = df.schema["grid"].dataType
        single = df.withColumn("grid", F.concat(F.col("channel"), F.lit(SEPARATOR), F.col("grid").cast("string"))).drop("channel")
        out = step(single, argument)
        cut = F.instr("grid", SEPARATOR)
        named = out.withColumn("channel", F.expr(f"substring(grid, 1, instr(grid, '{SEPARATOR}') - 1)"))
        return named.withColumn("grid", F.substring(F.col("grid"), cut + 1, F.length("grid")).cast(kind)).select("grid", "x", "y", "channel", "v")

    return run


def crop(df: DataFrame, margin: int) -> DataFrame:
    """Crop to the foreground of the grid, of its luma if there are channels, and count cells from (0, 0) again."""
    if "channel" in df.columns:
        inside = grid.crop_to_foreground(grid.luma(df), margin).select("grid", "x", "y")
        df = df.join(inside, ["grid", "x", "y"], "left_semi")
    else:
        df = grid.crop_to_foreground(df, margin)
    corner = df.groupBy("grid").agg(F.min("x").alias("__x"), F.min("y").alias("__y"))
    moved = attach(df, corner, ["grid"]).withColumns({"x": (F.col("x") - F.col("__x")).cast("int"), "y": (F.col("y") - F.col("__y")).cast("int")})
    return moved.drop("__x", "__y")


def equalize(df: DataFrame, wanted: bool) -> DataFrame:
    """Equalise the histogram; with channels that of the luma, whose change is added to every channel."""
    if wanted is not True:
        raise ValueError(f"equalize is {wanted!r}, not True or False")
    if "channel" not in df.columns:
        return grid.equalize(df)
    before = grid.luma(df)
    after = grid.equalize(before).select("grid", "x", "y", F.col("v").alias("__after"))
    change = before.select("grid", "x", "y", F.col("v").alias("__before")).join(after, ["grid", "x", "y"])
    moved = F.col("v") + F.col("__after") - F.col("__before")
    out = df.join(change, ["grid", "x", "y"]).withColumn("v", F.greatest(F.lit(0.0), F.least(F.lit(255.0), moved)))
    return out.drop("__before", "__after")


def normalize(df: DataFrame, method: str) -> DataFrame:
    """Rescale each grid, over all its channels, to whole levels 0 to 255."""
    if method == "minmax":
        return grid.normalize(df)
    levels = {"zscore": scale.zscore_within, "robust": scale.percentile_clip_within}
    return levels[method](df, "grid", "v").withColumn("v", F.floor(F.col("v") * 255).cast("double"))


def chosen(choices: dict) -> Callable:
    """A step whose argument names one of the choices."""

    def run(df: DataFrame, name) -> DataFrame:
        return choices[name](df)

    return run


# Steps in the order in which they run; a configuration switches them on and sets their argument.
STEPS = {
    "crop": crop,
    "channel_balance": lambda df, _: grid.channel_balance(df),
    "gamma": grid.gamma_curve,
    "denoise": per_channel(chosen({"gaussian": grid.gaussian_blur, "median": grid.median_filter})),
    "equalize": equalize,
    "laplacian": per_channel(lambda df, _: grid.laplacian(df)),
    "sobel": per_channel(lambda df, _: grid.sobel_magnitude(df)),
    "gabor": per_channel(grid.gabor),
    "high_boost": per_channel(grid.high_boost),
    "sharpen": per_channel(grid.sharpen),
    "luma": lambda df, _: grid.luma(df),
    "normalize": normalize,
}
# Arguments of the steps that name a method.
METHODS = {"denoise": ("gaussian", "median"), "normalize": ("minmax", "zscore", "robust")}


def prepare(df: DataFrame, config: dict) -> DataFrame:
    """Apply the configured steps; an unknown step or method is an error."""
    unknown = set(config) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    for name, methods in METHODS.items():
        if config.get(name) not in (None, False, *methods):
            raise ValueError(f"{name} is {config[name]!r}, not one of {methods}")
    steps = [(step, config[name]) for name, step in STEPS.items() if config.get(name) not in (None, False)]
    return reduce(lambda frame, s: s[0](frame, s[1]), steps, df)


def run_variants(df: DataFrame, variants: dict[str, dict]) -> DataFrame:
    """All variants of all grids in one table with a ``variant`` column, and ``channel`` where the grids have channels to the end."""
    frames = []
    for name, config in variants.items():
        out = prepare(df, config)
        extra = ["channel"] if "channel" in out.columns else []
        frames.append(out.select(F.lit(name).alias("variant"), "grid", *extra, "x", "y", F.col("v").cast("double").alias("v")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
