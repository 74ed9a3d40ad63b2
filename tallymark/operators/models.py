"""Classifiers and clusters behind one interface.

A training frame has the columns ``key, label, vec`` (0/1 label, array of doubles). ``fit`` returns a function that
maps any such frame to ``key, label, score, prediction``. Parameters keep the names of the search spaces; those without
a counterpart are listed by ``ignored_parameters``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.rng import gauss, u
from tallymark.functions.vectors import distance, times_matrix
from tallymark.operators.features import width_of
from tallymark.operators.neighbours import knn_classify
from tallymark.operators.split import class_weight
from tallymark.session import parallelism

SEED = 42
Predictor = Callable[[DataFrame], DataFrame]

# Search-space names of the parameters and the estimator parameter they set.
TREE = {"max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode", "criterion": "impurity"}
FOREST = {**TREE, "n_estimators": "numTrees", "max_features": "featureSubsetStrategy"}
BOOSTING = {
    "n_estimators": "maxIter", "iterations": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth", "depth": "maxDepth",
    "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy", "min_child_weight": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode", "min_samples_leaf": "minInstancesPerNode", "gamma": "minInfoGain",
}
USED = {
    "logistic": {"C", "penalty", "class_weight", "max_iter"}, "tree": {*TREE, "class_weight"}, "forest": {*FOREST, "class_weight"}, "boosting": set(BOOSTING), "svm": {"C", "gamma", "class_weight", "features", "kernel", "max_iter"},
    "knn": {"n_neighbors", "weights", "metric", "p", "pivots"}, "bayes": {"var_smoothing"}, "perceptron": {"layers", "epochs"},
}
# Training rows that are worth a task of their own.
TASK_ROWS = 20_000
# Most training rows of a task; more are dealt anew.
MOST_TASK_ROWS = 200_000
# Deepest tree the engine can hold.
MAX_DEPTH = 30


def ignored_parameters(model: str, params: dict) -> list[str]:
    """Parameters of a search space that have no effect here."""
    return sorted(set(params) - USED[model])


def fit(model: str, train: DataFrame, params: dict | None = None) -> Predictor:
    return FITTERS[model](train, dict(params or {}))


def as_vector(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector("vec"))


def compact(train: DataFrame) -> DataFrame:
    """Training rows in tasks of some size: a fit is many short jobs, and tasks of a few rows only cost their start.

    Many rows in few files are dealt to tasks that hold MOST_TASK_ROWS, and to every slot, so no task grows with the input.
    """
    n = train.count()
    if n > MOST_TASK_ROWS * parallelism(train.sparkSession):
        return train.repartition(math.ceil(n / MOST_TASK_ROWS))
    return train.coalesce(max(1, math.ceil(n / TASK_ROWS)))


def _predictor(fitted, score: Column) -> Predictor:
    def predict(df: DataFrame) -> DataFrame:
        return fitted.transform(as_vector(df)).select("key", "label", score.alias("score"), F.col("prediction").cast("int").alias("prediction"))

    return predict


def _settings(params: dict, names: dict) -> dict:
    chosen = {names[k]: v for k, v in params.items() if k in names}
    if "maxDepth" in chosen:
        chosen["maxDepth"] = int(chosen["maxDepth"])
        if chosen["maxDepth"] > MAX_DEPTH:
            raise ValueError(f"trees can be {MAX_DEPTH} deep at most, {chosen['maxDepth']} was asked for")
    if "minInstancesPerNode" in chosen:
        chosen["minInstancesPerNode"] = int(chosen["minInstancesPerNode"])
    if "featureSubsetStrategy" in chosen:
        value = chosen["featureSubsetStrategy"]
        chosen["featureSubsetStrategy"] = "all" if value in (None, "None") else value if isinstance(value, str) else f"{value:.6f}"
    return chosen


def positive_share() -> Column:
    return vector_to_array(F.col("probability"))[1]


def weighted(train: DataFrame, params: dict) -> DataFrame:
    """``train`` with a column ``weight``: n / (2 n_c) with ``class_weight="balanced"``, else 1."""
    chosen = params.get("class_weight")
    if chosen not in (None, "balanced"):
        raise ValueError(f"class_weight is {chosen!r}, not None or 'balanced'")
    return class_weight(train, "label") if chosen else train.withColumn("weight", F.lit(1.0))


def fit_logistic(train: DataFrame, params: dict) -> Predictor:
    """Penalised by 1 / (C n), so that C means the same at every size."""
    n = train.count()
    estimator = LogisticRegression(
        regParam=1.0 / (params.get("C", 1.0) * n), elasticNetParam=1.0 if params.get("penalty") == "l1" else 0.0,
        standardization=False, maxIter=params.get("max_iter", 1000), weightCol="weight",
    )
    return _predictor(estimator.fit(as_vector(weighted(compact(train), params))), positive_share())


def fit_tree(train: DataFrame, params: dict) -> Predictor:
    estimator = DecisionTreeClassifier(seed=SEED, weightCol="weight", **_settings(params, TREE))
    return _predictor(estimator.fit(as_vector(weighted(compact(train), params))), positive_share())


def forest_model(train: DataFrame, params: dict):
    settings = {"numTrees": 100, **_settings(params, FOREST)}
    return RandomForestClassifier(seed=SEED, weightCol="weight", **settings).fit(as_vector(weighted(compact(train), params)))


def fit_forest(train: DataFrame, params: dict) -> Predictor:
    return _predictor(forest_model(train, params), positive_share())


def fit_boosting(train: DataFrame, params: dict) -> Predictor:
    settings = {"maxIter": 100, "maxDepth": 3, **_settings(params, BOOSTING)}
    return _predictor(GBTClassifier(seed=SEED, **settings).fit(as_vector(compact(train))), positive_share())


def waves_of(spark: SparkSession, features: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (width x features, for gamma 1/2) and shifts of random Fourier features, drawn from hashes."""
    cells = spark.range(features * width).select(F.expr(f"id div {width}").alias("o"), (F.col("id") % width).alias("j"))
    waves = np.zeros((width, features))
    for r in cells.select("o", "j", gauss(F.concat_ws("_", "o", "j"), "w").alias("g")).collect():
        waves[r["j"], r["o"]] = r["g"]
    shifts = [r["b"] for r in spark.range(features).orderBy("id").select((u("id", "b") * 2 * math.pi).alias("b")).collect()]
    return waves, np.array(shifts)


def fourier_features(df: DataFrame, gamma: float, features: int, width: int) -> DataFrame:
    """Random features whose dot product approximates exp(-gamma |x - y|^2); drawn from hashes, so fit and apply agree."""
    waves, shift = waves_of(df.sparkSession, features, width)
    scale = math.sqrt(2.0 / features)
    return df.withColumn("vec", times_matrix("vec", waves * math.sqrt(2.0 * gamma), lambda product: scale * np.cos(product + shift)))


def fit_svm(train: DataFrame, params: dict) -> Predictor:
    """Linear classifier with a hinge loss on random Fourier features, or on the vectors when ``features`` is 0.

    ``gamma`` is a number, ``auto`` (1 / width) or ``scale`` (1 / (width x mean variance)).
    """
    if params.get("kernel", "rbf") != "rbf":
        raise ValueError(f"kernel {params['kernel']!r} has no counterpart; features=0 is the linear one")
    width = width_of(train, "vec")
    gamma, features = params.get("gamma", "scale"), params.get("features", 64)
    if gamma == "auto":
        gamma = 1.0 / width
    elif gamma == "scale":
        variances = train.agg(*[F.var_pop(F.col("vec")[i]).alias(f"v{i}") for i in range(width)]).first()
        gamma = 1.0 / max(sum(variances), 1e-12)
    lift = (lambda df: fourier_features(df, gamma, features, width)) if features else (lambda df: df)
    estimator = LinearSVC(regParam=1.0 / (params.get("C", 1.0) * train.count()), weightCol="weight", maxIter=params.get("max_iter", 1000))
    fitted = estimator.fit(as_vector(lift(weighted(compact(train), params))))
    inner = _predictor(fitted, vector_to_array(F.col("rawPrediction"))[1])
    return lambda df: inner(lift(df))


def fit_knn(train: DataFrame, params: dict) -> Predictor:
    p = {"euclidean": 2.0, "manhattan": 1.0, "minkowski": float(params.get("p", 2))}[params.get("metric", "euclidean")]

    def predict(df: DataFrame) -> DataFrame:
        votes = knn_classify(train, df, int(params.get("n_neighbors", 5)), "key", "label", p=p, weights=params.get("weights", "uniform"), pivots=params.get("pivots"))
        return df.select("key", "label").join(votes, "key").select("key", "label", "score", "prediction")

    return predict


def fit_bayes(train: DataFrame, params: dict) -> Predictor:
    """Gaussian naive Bayes: class means and variances from one aggregation, scored by a plain column expression."""
    smoothing, width = params.get("var_smoothing", 1e-9), width_of(train, "vec")
    dims = range(width)
    moments = [a for i in dims for a in (F.avg(F.col("vec")[i]).alias(f"m{i}"), F.var_pop(F.col("vec")[i]).alias(f"v{i}"))]
    rows = {r["label"]: r for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *moments).collect()}
    n = sum(r["n"] for r in rows.values())
    # Variance over all rows from the class moments, without a second pass.
    whole = []
    for i in dims:
        mean = sum(r["n"] * r[f"m{i}"] for r in rows.values()) / n
        whole.append(sum(r["n"] * (r[f"v{i}"] + (r[f"m{i}"] - mean) ** 2) for r in rows.values()) / n)
    floor = smoothing * max(whole)

    def joint(label: int) -> Column:
        r = rows[label]
        value = F.lit(math.log(r["n"] / n))
        for i in dims:
            s = r[f"v{i}"] + floor
            gap = F.col("vec")[i] - F.lit(r[f"m{i}"])
            value = value + F.lit(-0.5 * math.log(2 * math.pi * s)) - gap * gap / F.lit(2 * s)
        return value

    def predict(df: DataFrame) -> DataFrame:
        if len(rows) < 2:
            only = next(iter(rows))
            return df.select("key", "label", F.lit(float(only)).alias("score"), F.lit(only).alias("prediction"))
        margin = joint(1) - joint(0)
        return df.select("key", "label", margin.alias("margin")).select(
            "key", "label", (1.0 / (1.0 + F.exp(-F.col("margin")))).alias("score"), (F.col("margin") > 0).cast("int").alias("prediction")
        )

    return predict


def fit_perceptron(train: DataFrame, params: dict) -> Predictor:
    """Layers 64-32-16-8 for 25 epochs unless told otherwise."""
    layers = [width_of(train, "vec"), *params.get("layers", [64, 32, 16, 8]), 2]
    estimator = MultilayerPerceptronClassifier(layers=layers, maxIter=params.get("epochs", 25), seed=SEED)
    return _predictor(estimator.fit(as_vector(compact(train))), positive_share())


FITTERS = {
    "logistic": fit_logistic, "tree": fit_tree, "forest": fit_forest, "boosting": fit_boosting, "svm": fit_svm, "knn": fit_knn,
    "bayes": fit_bayes, "perceptron": fit_perceptron,
}


def in_parallel(tasks: list[Callable], threads: int = 8) -> list:
    """Run independent fits at the same time; each is a Spark job, the threads only submit."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def lloyd_step(df: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Assign every row to its nearest centre (the first on a tie) and recompute: ``cluster, n, centre``."""
    width = len(centres[0])
    gaps = F.array(*[distance(F.col("vec"), F.lit([float(x) for x in c])) for c in centres])
    nearest = (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")
    assigned = df.withColumn("cluster", nearest)
    means = F.array(*[F.avg(F.col("vec")[i]) for i in range(width)])
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), means.alias("centre"))
