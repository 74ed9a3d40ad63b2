"""Anomaly scores of vectors, fitted on normal rows only."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators import columns, evaluate, scale
from tallymark.operators.neighbours import knn_join
from tallymark.operators.resample import noised
from tallymark.session import written


def memory_bank_score(scored: DataFrame, bank: DataFrame, key: str, vec: str, k: int, pivots: int | None = None) -> DataFrame:
    """``key, score``: mean distance to the k nearest bank vectors; ``pivots`` as in ``knn_join``."""
    pairs = knn_join(scored, bank, k, key, key, vec, vec, pivots=pivots)
    return pairs.groupBy(F.col("left_key").alias(key)).agg(F.avg("distance").alias("score"))


def patch_scores(scores: DataFrame, parts: DataFrame, key: str, item: str) -> DataFrame:
    """Add the item of every part and the item score: the highest score among its parts. The map of parts is kept."""
    mapped = scores.join(parts.select(key, item), key)
    highest = mapped.groupBy(item).agg(F.max("score").alias("item_score"))
    return mapped.join(highest, item)


def noise_discriminator(normal: DataFrame, scored: DataFrame, key: str, vec: str, sigma: float, reg: float = 0.001, max_iter: int = 1000) -> DataFrame:
    """``key, score``: probability of being a noised row, from a classifier of normal rows against noised copies."""
    shaken = noised(normal, key, vec, sigma).select(F.col("noised").alias(vec), F.lit(1.0).alias("y"))
    training = normal.select(vec, F.lit(0.0).alias("y")).unionByName(shaken)
    # Noise hides in the size of the coordinates, so their squares join the features.
    features = lambda df: df.withColumn(
        "x", array_to_vector(F.concat(F.col(vec), F.transform(vec, lambda v: v * v)))
    )
    # Every iteration reads the training rows, so the draws are made once.
    model = LogisticRegression(featuresCol="x", labelCol="y", regParam=reg, maxIter=max_iter).fit(features(written(training)))
    return model.transform(features(scored)).select(key, vector_to_array("probability")[1].alias("score"))


def fuse(a: DataFrame, b: DataFrame, key: str, weight: float = 0.5) -> DataFrame:
    """Weighted sum of two score tables with the same keys."""
    joined = a.select(key, F.col("score").alias("__a")).join(b.select(key, F.col("score").alias("__b")), key)
    return joined.select(key, (weight * F.col("__a") + (1 - weight) * F.col("__b")).alias("score"))


def evaluate_scores(tune: DataFrame, test: DataFrame, score: str, label: str) -> DataFrame:
    """Rescale by the tuning rows, choose the threshold there, and report the metrics on the test rows.

    Pass the same frame twice to choose and evaluate on one set.
    """
    fitted = scale.fit_minmax(tune, [score])
    tuned = scale.transform(tune, fitted, [score])
    threshold = evaluate.youden_threshold(tuned, score, label).first()["threshold"]
    scaled = scale.transform(test, fitted, [score])
    predicted = scaled.withColumn("prediction", columns.predict_at(score, F.lit(threshold)))
    metrics = evaluate.binary_metrics(predicted, label, "prediction")
    return metrics.withColumns({
        "threshold": F.lit(threshold), "auc": F.lit(evaluate.roc_auc(scaled, score, label).first()["auc"]),
    })
