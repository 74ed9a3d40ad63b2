"""Principal components: covariance on the cluster, eigenvectors of the small matrix on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.vectors import times_matrix
from tallymark.operators.features import mean_vector
from tallymark.operators.moments import cross_products


@dataclass
class Components:
    mean: np.ndarray
    axes: np.ndarray  # one row per kept component
    ratio: np.ndarray  # share of the variance per kept component
    values: np.ndarray  # variance along each kept component
    total: float  # variance over all coordinates


def fit_pca(df: DataFrame, vec: str, components: int | None = None, variance: float | None = None) -> Components:
    """Keep ``components`` axes, or the fewest whose shares of variance sum to more than ``variance``.

    Only the width x width covariance reaches the driver. The largest entry of an axis is positive.
    """
    mean = np.array(mean_vector(df, vec))
    total, n = cross_products(df, vec, mean)
    covariance = total / max(n - 1, 1)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1]
    values, axes = np.clip(values[order], 0, None), vectors[:, order].T
    axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    ratio = values / values.sum()
    if components is None:
        components = int(np.searchsorted(ratio.cumsum(), variance, side="right")) + 1
    return Components(mean, axes[:components], ratio[:components], values[:components], float(np.trace(covariance)))


def project(df: DataFrame, fitted: Components, vec: str, output: str) -> DataFrame:
    """Coordinates along the kept axes, centred on the fitted mean."""
    offset = fitted.axes @ fitted.mean
    return df.withColumn(output, times_matrix(vec, fitted.axes.T, lambda product: product - offset))


def reconstruction_error(df: DataFrame, fitted: Components, vec: str, output: str) -> DataFrame:
    """Mean squared error after projecting on the axes and back.

    The axes are orthonormal, so the error is (|centred|^2 - |coordinates|^2) / width; no back-projection is needed.
    """
    projected = project(df, fitted, vec, "__p")
    centred = F.zip_with(F.col(vec), F.lit([float(m) for m in fitted.mean]), lambda x, m: x - m)
    squares = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)
    error = (squares(centred) - squares(F.col("__p"))) / F.size(vec)
    return projected.withColumn(output, F.greatest(F.lit(0.0), error)).drop("__p")


def residuals(df: DataFrame, fitted: Components, vec: str) -> DataFrame:
    """How well the components fit the rows: ``component, variance, eigen_gap, tilt``, from one pass over the projected rows.

    ``variance`` is that of the rows along the component, ``eigen_gap`` the length of C v - lambda v over the total variance,
    ``tilt`` the largest product with another kept component, off one for itself.
    """
    covariance, n = cross_products(df, vec, fitted.mean)
    covariance = covariance / max(n - 1, 1)
    image = fitted.axes @ covariance
    gap = np.linalg.norm(image - fitted.values[:, None] * fitted.axes, axis=1) / max(fitted.total, 1e-300)
    tilt = np.abs(fitted.axes @ fitted.axes.T - np.eye(len(fitted.axes))).max(axis=1)
    along = (image * fitted.axes).sum(axis=1)
    rows = [(i, float(v), float(g), float(t)) for i, (v, g, t) in enumerate(zip(along, gap, tilt))]
    return df.sparkSession.createDataFrame(rows, "component int, variance double, eigen_gap double, tilt double")
