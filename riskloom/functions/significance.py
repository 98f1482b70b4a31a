"""Two-sided p-value of a correlation coefficient.

Spark has no Student-t distribution. The function runs on aggregated rows only (one per test), so a Python function
over a handful of values is enough.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the front with the modified Lentz method.

    NaN if it has not settled within the terms allowed.
    """
    tiny = 1e-300
    front, c, d = 1.0, 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    front = d
    for m in range(1, 200_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            front *= d * c
        if abs(d * c - 1.0) < 1e-15:
            return front
    return math.nan


def _log_beta_half(a: float) -> float:
    """log B(a, 1/2); the difference of two large log-gammas is replaced by its series."""
    if a < 1e4:
        return math.lgamma(a) + math.lgamma(0.5) - math.lgamma(a + 0.5)
    return math.lgamma(0.5) - (0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3))


def correlation_p(r: float, n: float) -> float | None:
    """p-value of ``t = r * sqrt((n-2) / (1-r^2))`` with ``n-2`` degrees of freedom.

    It is the regularised incomplete beta function ``I(1-r^2; (n-2)/2, 1/2)``, and None where its series does not settle.
    """
    if r is None or n is None or r != r or n < 3:
        return None
    near, far = max(0.0, 1.0 - r * r), min(1.0, r * r)
    if near == 0.0 or far == 0.0:
        return near
    a, b = (n - 2) / 2.0, 0.5
    scale = math.exp(a * math.log1p(-far) + b * math.log(far) - _log_beta_half(a))
    if near < (a + 1.0) / (a + b + 2.0):
        p = scale * _beta_fraction(a, b, near) / a
    else:
        p = 1.0 - scale * _beta_fraction(b, a, far) / b
    return None if p != p else p


@F.pandas_udf(T.DoubleType())
def _p_values(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([correlation_p(a, b) for a, b in zip(r, n)], dtype="float64")


def p_value(r: Column, n: Column) -> Column:
    p = _p_values(r.cast("double"), n.cast("double"))
    return F.when(r.isNotNull() & (n >= 3), p)
