"""Tail probabilities for one-row summaries.

Spark SQL has no t, F or normal distribution function. These small helpers run
as Arrow-batched UDFs over summary rows only, never over observations.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F, types as T


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    tiny = 1e-300
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    total = d
    for m in range(1, 1_000_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            total *= step
        if abs(step - 1.0) < 1e-15:
            return front * total
    raise ArithmeticError(f"incomplete beta({a}, {b}) at {x} has not settled")


# From here on a ratio of variances is taken as a chi-square, whose error falls with the square of the degrees of freedom;
# below, the exact fraction settles fast and its logarithms keep their digits.
LARGE = 1e5


def chi_square_upper(x: float, d: float) -> float:
    """Upper tail of a chi-square with d degrees of freedom: a series below the mean, a continued fraction above."""
    a, h = d / 2.0, x / 2.0
    if h <= 0.0:
        return 1.0
    if math.isinf(h):
        return 0.0
    front = math.exp(a * math.log(h) - h - math.lgamma(a))
    if h < a + 1.0:
        term = total = 1.0 / a
        k = a
        while term > total * 1e-17:
            k += 1.0
            term *= h / k
            total += term
        return 1.0 - front * total
    # modified Lentz
    b, c = h + 1.0 - a, 1e300
    e = 1.0 / b
    total, i = e, 0
    while True:
        i += 1
        top = -i * (i - a)
        b += 2.0
        e = 1.0 / (b + top * e)
        c = b + top / c
        total *= c * e
        if abs(c * e - 1.0) < 1e-15:
            return front * total


def _scaled(f: float, d1: float, d2: float) -> float:
    """The chi-square value with d1 degrees of freedom whose tail is that of F for a large d2."""
    return (d2 + d1 / 2.0 - 1.0) * math.log1p(d1 * f / d2)


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    if df > LARGE:
        return math.erfc(math.sqrt(_scaled(t * t, 1.0, df) / 2.0))
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def f_upper(f: float, d1: float, d2: float) -> float:
    if f <= 0:
        return 1.0
    if d2 > LARGE:
        return chi_square_upper(_scaled(f, d1, d2), d1)
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def _missing(*values) -> bool:
    return any(v is None or math.isnan(v) for v in values)


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if _missing(a, b) or b <= 0 else t_two_sided(a, b) for a, b in zip(t, df)],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_p_value(z: pd.Series) -> pd.Series:
    return pd.Series([None if _missing(v) else normal_two_sided(v) for v in z], dtype="float64")
