"""Distribution tails for test statistics (Student t two-sided, chi-square upper tail).

They run as Arrow-batched pandas UDFs over the one-row-per-feature results of the tests, so the
heavy work (ranks, sums) stays in Spark and only a handful of rows reach Python.

Regularised incomplete beta: continued fraction (modified Lentz).
Regularised upper incomplete gamma: series below a + 1, continued fraction above.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300
_MAXIT = 100_000
_LARGE_DF = 1e6


def _beta_cf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, _MAXIT + 1):
        m2 = 2 * m
        num = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + num * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + num / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        num = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + num * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + num / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        if abs(step - 1.0) < _EPS:
            return h
    raise ArithmeticError(f"continued fraction did not converge for a={a}, b={b}, x={x}")


def betainc_reg(a: float, b: float, x: float) -> float:
    """I_x(a, b)."""
    if x is None or math.isnan(x) or a <= 0 or b <= 0:
        return float("nan")
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1.0 - x) / b


def gammaincc_reg(a: float, x: float) -> float:
    """Q(a, x) = 1 - P(a, x)."""
    if x is None or math.isnan(x) or a <= 0:
        return float("nan")
    if x <= 0.0:
        return 1.0
    ln_front = -x + a * math.log(x) - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        ap = a
        for _ in range(_MAXIT):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                return max(0.0, 1.0 - total * math.exp(ln_front))
        raise ArithmeticError(f"series did not converge for a={a}, x={x}")
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _MAXIT + 1):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        if abs(step - 1.0) < _EPS:
            return math.exp(ln_front) * h
    raise ArithmeticError(f"continued fraction did not converge for a={a}, x={x}")


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p of Student t: I_{df/(df+t^2)}(df/2, 1/2); the normal tail with its first corrections for large df."""
    if t is None or df is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    if df > _LARGE_DF:  # the log-gamma difference would cancel; the terms left out are of order df^-2
        z = abs(t) * (1.0 - 1.0 / (4.0 * df)) / math.sqrt(1.0 + t * t / (2.0 * df))
        return math.erfc(z / math.sqrt(2.0))
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


def chi2_sf(x: float, k: float) -> float:
    """Upper tail of chi-square with k degrees of freedom."""
    if x is None or k is None or math.isnan(x) or k <= 0:
        return float("nan")
    return gammaincc_reg(k / 2.0, x / 2.0)


@F.pandas_udf(T.DoubleType())
def t_two_sided_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b))
                      for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b))
                      for a, b in zip(x, k)], dtype="float64")
