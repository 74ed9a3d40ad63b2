"""Classification trees grown level by level from histograms.

A level is one aggregate over (node, feature, bin): every row adds to one cell for each feature, cells are combined before the
shuffle, and their number does not depend on the rows. Only the chosen splits, at most one a node, come to the driver.

Nodes are numbered like a heap: the root is 1, the children of ``node`` are ``2 node`` (bins up to the split) and ``2 node + 1``.
A null feature value lies in the lowest bin; rows without a label are left out of the fit; a table without rows gives the
root alone, with 0 rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import attach, written

#: Gains are compared, and ties found, at this many digits.
GAIN_DIGITS = 9
#: The splits, at most two to this power, are constants of the plan.
MAX_DEPTH = 14
SPLIT = "node bigint, feature string, bin int, cut double, gain double"


@dataclass(frozen=True)
class Tree:
    """Equal-width bins of the features, the splits, and all nodes with ``n`` rows and ``positives``."""

    edges: dict[str, tuple[float, float]]
    bins: int
    splits: list[tuple]
    nodes: DataFrame


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """Number of the equal-width bin; values outside the fitted range belong to the outer bins."""
    if not high > low:
        return F.lit(0)
    at = F.floor((value.cast("double") - F.lit(low)) / F.lit(high - low) * F.lit(bins))
    return F.when(at.isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(at, F.lit(bins - 1)))).cast("int")


def impurity(n: Column, positives: Column, criterion: str) -> Column:
    """Entropy in bits or Gini impurity of a node with two classes."""
    share = positives / n
    if criterion == "gini":
        return 2 * share * (1 - share)
    if criterion != "entropy":
        raise ValueError(f"criterion is {criterion!r}, not 'entropy' or 'gini'")
    return F.when((positives == 0) | (positives == n), 0.0).otherwise(-share * F.log2(share) - (1 - share) * F.log2(1 - share))


def split_step(binned: DataFrame, features: list[str], criterion: str = "entropy", min_rows: int = 1) -> DataFrame:
    """``node, feature, bin, gain``: the best split of each node that has one with a gain and ``min_rows`` rows on both sides.

    ``binned`` has ``node, label`` and the bin of every feature. Of equal gains the feature that comes first by name, then the lower
    bin wins.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("bin")) for c in features])
    histogram = binned.select("node", "label", F.inline(cells)).groupBy("node", "feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")
    )
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = histogram.select(
        "node", "feature", "bin", F.sum("n").over(upto).alias("ln"), F.sum("positives").over(upto).alias("lp"),
        F.sum("n").over(whole).alias("n"), F.sum("positives").over(whole).alias("p"),
    )
    rn, rp = F.col("n") - F.col("ln"), F.col("p") - F.col("lp")
    below = F.col("ln") / F.col("n") * impurity(F.col("ln"), F.col("lp"), criterion) + rn / F.col("n") * impurity(rn, rp, criterion)
    gain = F.round(impurity(F.col("n"), F.col("p"), criterion) - below, GAIN_DIGITS)
    valid = sides.filter((F.col("ln") >= min_rows) & (rn >= max(min_rows, 1))).withColumn("gain", gain).filter("gain > 0")
    first = Window.partitionBy("node").orderBy(F.desc("gain"), "feature", "bin")
    return valid.withColumn("__r", F.row_number().over(first)).filter("__r = 1").select("node", "feature", "bin", "gain")


def placed(binned: DataFrame, features: list[str], splits: list[tuple]) -> DataFrame:
    """``binned`` with the node each row comes to from the root. A projection: the splits are constants, indexed by node."""
    levels = max((s[0].bit_length() for s in splits), default=0)
    which, at = [-1] * 2**levels, [0] * 2**levels
    for node, feature, split_bin, *_ in splits:
        which[node], at[node] = features.index(feature), split_bin
    own = F.array(*features)

    def child(node: Column, _: Column) -> Column:
        feature = F.coalesce(F.get(F.lit(which), node.cast("int")), F.lit(-1))
        right = (F.get(own, feature) > F.get(F.lit(at), node.cast("int"))).cast("bigint")
        return F.when(feature < 0, node).otherwise(2 * node + right)

    root = F.lit(1).cast("bigint")
    return binned.withColumn("node", F.aggregate(F.sequence(F.lit(1), F.lit(levels)), root, child) if levels else root)


def _binned(df: DataFrame, edges: dict[str, tuple[float, float]], bins: int, *keep: Column | str) -> DataFrame:
    return df.select(*keep, *[bin_of(F.col(c), *edges[c], bins).alias(c) for c in edges])


def grow(
    df: DataFrame, features: list[str], label: str = "label", depth: int = 5, bins: int = 32, criterion: str = "entropy", min_rows: int = 1,
) -> Tree:
    """A tree of at most ``depth`` levels of splits; each level reads the rows once."""
    if depth > MAX_DEPTH:
        raise ValueError(f"trees can be {MAX_DEPTH} deep at most, {depth} was asked for")
    known = df.filter(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("bigint"))
    ends = known.agg(*[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    edges = {c: (ends[f"lo{i}"] or 0.0, ends[f"hi{i}"] or 0.0) for i, c in enumerate(features)}
    base = written(_binned(known, edges, bins, "label"))
    splits = []
    for level in range(depth):
        # Nodes of the level are 2^level and above; rows in a smaller node have come to a leaf.
        rows = placed(base, features, splits)
        found = split_step(rows.filter(F.col("node") >= 2**level), features, criterion, min_rows).collect()
        if not found:
            break
        for r in found:
            low, high = edges[r["feature"]]
            splits.append((r["node"], r["feature"], r["bin"], low + (r["bin"] + 1) * (high - low) / bins, r["gain"]))
    leaf = placed(base, features, splits).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")).collect()
    counts = {1: [0, 0]}
    for r in leaf:  # a node holds what the leaves below it hold
        at = r["node"]
        while at:
            own = counts.setdefault(at, [0, 0])
            own[0] += r["n"]
            own[1] += r["positives"]
            at //= 2
    split = {s[0]: s for s in splits}
    table = [(node, *split.get(node, (None,) * 5)[1:], n, p) for node, (n, p) in sorted(counts.items())]
    return Tree(edges, bins, splits, df.sparkSession.createDataFrame(table, f"{SPLIT}, n bigint, positives bigint"))


def predict(df: DataFrame, tree: Tree, key: str = "key") -> DataFrame:
    """``key, node, score``: the leaf of each row and the share of class 1 among the training rows in it."""
    rows = placed(_binned(df, tree.edges, tree.bins, F.col(key).alias("__key")), list(tree.edges), tree.splits)
    shares = tree.nodes.select("node", (F.col("positives") / F.nullif(F.col("n"), F.lit(0))).alias("score"))
    return attach(rows.select("__key", "node"), shares, ["node"]).select(F.col("__key").alias(key), "node", "score")
