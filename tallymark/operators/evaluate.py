"""Metrics of scored and predicted rows. All follow from a few counts, so the data is read once per metric table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.ranking import with_running_totals
from tallymark.session import attach, settled

AUPRO_THRESHOLDS = 100
EPSILON = 1e-8


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """``[by..], tn, fp, fn, tp``; cells that never occur are 0."""
    cell = lambda y, p: F.count_if((F.col(label) == y) & (F.col(prediction) == p))
    return df.groupBy(*(by or [])).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from the four cells; 0 where a ratio has no denominator."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn), "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn), "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    })


def binary_metrics(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    return metrics_from_counts(confusion_matrix(df, label, prediction, by))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, and their macro and weighted means."""
    pairs = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # Each pair counts for its true class and for its predicted class, so one grouping serves all classes.
    hit, none = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0), F.lit(0).cast("bigint")

    def side(name: str, tp: Column, support: Column, predicted: Column) -> Column:
        return F.struct(F.col(name).alias("class"), tp.alias("tp"), support.alias("support"), predicted.alias("predicted"))

    sides = pairs.select(F.inline(F.array(side("y", hit, F.col("n"), none), side("p", none, none, F.col("n")))))
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    per_class = sums.select(
        F.col("class").cast("string").alias("class"), ratio_or_zero(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("support")).alias("recall"),
        ratio_or_zero(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support",
    )
    names = ["precision", "recall", "f1"]
    macro = per_class.agg(F.lit("macro").alias("class"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per_class.agg(
        F.lit("weighted").alias("class"),
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)


def roc_points(df: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """``[by..], threshold, pos, neg, tp, fp, tpr, fpr`` in descending score order, ties collapsed; a null score is an error.

    Positives and negatives are counted per distinct score once; running totals of many distinct scores go through
    range buckets.
    """
    by = list(by or [])
    known = F.coalesce(F.col(score), F.raise_error(F.lit("a row without a score cannot be ranked")).cast(df.schema[score].dataType))
    counts, is_small = settled(df.groupBy(*by, known.alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"), F.sum((F.col(label) == 0).cast("bigint")).alias("neg")
    ))
    running = with_running_totals(
        counts, "threshold", {"tp": "pos", "fp": "neg"}, within=by, descending=True, small=is_small
    )
    total = counts.groupBy(*by).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    return attach(running, total, by).withColumns({
        "tpr": ratio_or_zero(F.col("tp"), F.col("positives")), "fpr": ratio_or_zero(F.col("fp"), F.col("negatives")),
    })


def roc_auc(df: DataFrame, score: str, label: str, by: list[str] | None = None, undefined: float = 0.5) -> DataFrame:
    """``[by..], auc``: the chance that a positive outranks a negative, ties counting half; ``undefined`` with one class."""
    points = roc_points(df, score, label, by)
    wins = F.col("pos") * (F.col("negatives") - F.col("fp") + F.col("neg") / 2)
    auc = F.sum(wins.cast("double")) / (F.max("positives").cast("double") * F.max("negatives"))
    one_class = (F.max("positives") == 0) | (F.max("negatives") == 0)
    return points.groupBy(*(by or [])).agg(F.when(one_class, F.lit(undefined)).otherwise(auc).alias("auc"))


def scored_metrics(df: DataFrame, score: str, label: str, prediction: str, by: list[str]) -> DataFrame:
    """All metrics of each group: counts, accuracy, precision, recall, F1 and AUC."""
    return binary_metrics(df, label, prediction, by).join(roc_auc(df, score, label, by), by)


def youden_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``threshold, j``: the largest TPR - FPR, the highest threshold on a tie. Compared as exact whole numbers."""
    wide = lambda a, b: F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")
    gain = (wide("tp", "negatives") - wide("fp", "positives")).cast("decimal(38,0)")
    points = roc_points(df, score, label).withColumn("gain", gain)
    best = points.agg(F.max_by(F.struct("threshold", "tpr", "fpr"), F.struct("gain", "threshold")).alias("r"))
    return best.select("r.threshold", (F.col("r.tpr") - F.col("r.fpr")).alias("j"))


def aupro_approx(cells: DataFrame, item: str, value: str, label: str) -> DataFrame:
    """One row ``aupro``: localisation score over 100 thresholds of the globally rescaled cell values.

    A cell lies above exactly ceil(99 v) of the thresholds i/99, so one histogram per item replaces a scan per
    threshold; what remains is one row per class and level.
    """
    edges = cells.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.max(label).alias("__any")).first()
    spark = cells.sparkSession
    if not edges["__any"]:
        return spark.createDataFrame([(0.0,)], "aupro double")
    if edges["__hi"] - edges["__lo"] < EPSILON:
        return spark.createDataFrame([(0.5,)], "aupro double")
    steps = AUPRO_THRESHOLDS - 1
    scaled = (F.col(value) - F.lit(edges["__lo"])) / F.lit(edges["__hi"] - edges["__lo"] + EPSILON)
    # The product can miss a threshold by rounding, so the neighbouring threshold is checked.
    guess = F.ceil(scaled * steps)
    level = F.when(guess / steps < scaled, guess + 1).when((guess - 1) / steps >= scaled, guess - 1).otherwise(guess)
    level = F.least(F.greatest(level, F.lit(0)), F.lit(AUPRO_THRESHOLDS)).cast("int")
    histogram = cells.groupBy(item, label, level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    per_item = attach(histogram, histogram.groupBy(item).agg(F.sum("n").alias("cells")), [item])
    shares = per_item.groupBy(label, "level").agg(F.sum(F.col("n") / F.col("cells")).alias("s"))
    items = cells.groupBy(label).agg(F.count_distinct(item).alias("items"))
    weights = attach(shares, items, [label]).select(label, "level", (F.col("s") / F.col("items")).alias("w"))
    # At most 101 levels per class from here on; a level counts for all thresholds below it.
    at = weights.select(label, "w", F.explode(F.expr("sequence(0, greatest(level, 1) - 1)")).alias("i"), "level").filter("level > 0")
    thresholds = spark.range(AUPRO_THRESHOLDS).select(F.col("id").cast("int").alias("i"))
    curve = thresholds.join(at, "i", "left").groupBy("i").agg(
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("w"))), F.lit(0.0)).alias("hit"),
        F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("w"))), F.lit(0.0)).alias("miss"),
    )
    keep = 1 - F.col("miss")
    blend = F.when(F.col("hit") + keep > 0, 2 * F.col("hit") * keep / (F.col("hit") + keep + EPSILON)).otherwise(0.0)
    following = F.lead("b").over(Window.orderBy("i"))
    area = curve.select("i", blend.alias("b")).select(((F.col("b") + following) / 2 / steps).alias("a"))
    return area.agg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.sum("a"))).alias("aupro"))


def focal_loss(probability: Column, label: Column, gamma: float = 2.0, alpha: float = 0.25) -> Column:
    """alpha * (1 - pt)^gamma * cross-entropy, pt being the probability given to the true class."""
    pt = F.when(label == 1, probability).otherwise(1 - probability)
    return F.lit(alpha) * F.pow(1 - pt, F.lit(gamma)) * -F.log(pt)
