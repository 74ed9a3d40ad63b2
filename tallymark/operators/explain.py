"""Which features matter: impurity importances, linear contributions, permutation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.rng import u
from tallymark.operators import evaluate, models
from tallymark.operators.ranking import bucket_count, unit_bucket, with_row_number
from tallymark.session import written


def forest_importance(frame: DataFrame, names: list[str], params: dict | None = None) -> DataFrame:
    """``feature, importance, selected``: selected when not below the mean importance."""
    weights = models.forest_model(frame, params or {}).featureImportances.toArray()
    mean = float(weights.mean())
    rows = [(n, float(w), bool(w >= mean)) for n, w in zip(names, weights)]
    return frame.sparkSession.createDataFrame(rows, "feature string, importance double, selected boolean")


def linear_attribution(frame: DataFrame, names: list[str], weights: list[float]) -> DataFrame:
    """``feature, contribution``: mean of |w (x - mean)|, the exact attribution of a linear model. Two aggregations."""
    means = frame.agg(*[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in range(len(names))]).first()
    parts = [F.avg(F.abs(F.lit(w) * (F.col("vec")[i] - F.lit(means[i])))).alias(f"c{i}") for i, w in enumerate(weights)]
    structs = [F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("contribution")) for i, n in enumerate(names)]
    return frame.agg(*parts).select(F.inline(F.array(*structs)))


def permutation_importance(frame: DataFrame, names: list[str], predict: models.Predictor, salt: str = "permute") -> DataFrame:
    """``feature, f1, drop``: F1 after one feature is taken from another row, and the loss against the full model.

    One hash-ordered permutation serves all features: row r lends its values to row r + 1, the last to the first.
    """
    drawn = frame.withColumn("__u", u("key", salt))
    buckets = unit_bucket(F.col("__u"), bucket_count(frame))
    ranked = written(with_row_number(drawn, "__r", [F.col("__u"), F.col("key")], buckets).drop("__u"))
    n = ranked.count()
    lender = ranked.select((F.col("__r") % n + 1).alias("__r"), F.col("vec").alias("other"))
    paired = written(ranked.join(lender, "__r"))

    def swapped(i: int) -> DataFrame:
        vec = F.transform(F.col("vec"), lambda x, j: F.when(j == i, F.element_at("other", i + 1)).otherwise(x))
        return predict(paired.select("key", "label", vec.alias("vec"))).withColumn("feature", F.lit(names[i]))

    full = predict(paired.select("key", "label", "vec")).withColumn("feature", F.lit("(none)"))
    scored = reduce(DataFrame.unionByName, [swapped(i) for i in range(len(names))], full)
    metrics = written(evaluate.binary_metrics(scored, "label", "prediction", ["feature"]).select("feature", "f1"))
    base = metrics.filter("feature = '(none)'").first()["f1"]
    return metrics.filter("feature != '(none)'").withColumn("drop", F.lit(base) - F.col("f1"))
