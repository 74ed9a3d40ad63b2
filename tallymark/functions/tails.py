"""Upper tails of the t and chi-square distributions for result tables with one row per tested column."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_tail(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 1000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / (1.0 + term * d)
            c = 1.0 + term / c
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * value


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: series below a + 1, continued fraction above."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1.0 - front * total
    b = x + 1 - a
    c, d = 1e300, 1.0 / b
    value = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * value


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([beta_tail(v / 2, 0.5, v / (v + x * x)) for x, v in zip(t, df)])


@F.pandas_udf(DoubleType())
def chi2_upper(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([gamma_tail(k / 2, s / 2) for s, k in zip(x, dof)])
