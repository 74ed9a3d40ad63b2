"""Array-column arithmetic: inside the JVM, and one matrix product per Arrow batch where every row meets a matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def doubles(v: Column | str) -> Column:
    v = F.col(v) if isinstance(v, str) else v
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def unit(v: Column) -> Column:
    """Divide by the Euclidean length; the zero vector stays zero."""
    length = norm(v)
    return F.transform(v, lambda x: F.when(length == 0, x).otherwise(x / length))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def distance(a: Column, b: Column, p: float = 2.0) -> Column:
    """Minkowski distance of order p."""
    if p == 1:
        return total(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    if p == 2:
        return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))
    return F.pow(total(F.zip_with(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(float(p))))), F.lit(1.0 / p))


def mean_of(v: Column) -> Column:
    return total(v) / F.size(v)


def times_matrix(v: Column | str, matrix: np.ndarray, after=None) -> Column:
    """Product of each vector with a small matrix (width x outputs); ``after`` maps the whole result matrix."""
    matrix = np.asarray(matrix, dtype=float)

    @F.pandas_udf(ArrayType(DoubleType()))
    def product(batch: pd.Series) -> pd.Series:
        if not len(batch):
            return pd.Series([], dtype=object)
        out = np.stack(batch.to_numpy()) @ matrix
        return pd.Series(list(out if after is None else after(out)))

    return product(v)
