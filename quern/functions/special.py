"""Tail probabilities of the t, F and chi-square distributions as pandas UDFs.

They run on a handful of test statistics, never on raw rows. Continued fractions
after Lentz; see Numerical Recipes, chapter 6, or DLMF 8.9 and 8.17.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300
#: A fraction or series that needs more terms is an error, not an answer.
_STEPS = 1_000_000


def _lentz(coefficients, start: float) -> float:
    """Value of start + a1/(b1 + a2/(b2 + ...)) for an iterator of (a, b)."""
    value = start or _TINY
    c, d = value, 0.0
    for a, b in coefficients:
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        value *= c * d
        if abs(c * d - 1.0) < 3e-16:
            return value
    raise ArithmeticError("A tail probability did not converge.")


def _log_beta(a: float, b: float) -> float:
    """Logarithm of the beta function, without differences of large numbers."""
    large, small = max(a, b), min(a, b)
    if large < 1e4:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    # Stirling's series of both large terms, subtracted term by term.
    total = large + small
    ratio = (large - 0.5) * math.log1p(small / large) + small * math.log(total) - small
    return math.lgamma(small) - ratio - (1 / total - 1 / large) / 12


def beta_tail(a: float, b: float, x: float, rest: float | None = None) -> float:
    """Regularised incomplete beta function I_x(a, b); ``rest`` is 1 - x where known exactly."""
    rest = 1.0 - x if rest is None else rest
    if x <= 0.0 or rest <= 0.0:
        return float(rest <= 0.0)
    if a > 1e6 and a > 1e4 * b:
        # Beside so large a parameter the gamma distribution is exact to 1e-11; the fraction is not.
        return gamma_tail(b, -(a + (b - 1.0) / 2.0) * (math.log(x) if x < 0.5 else math.log1p(-rest)))
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_tail(b, a, rest, x)

    def terms():
        for step in range(1, _STEPS):
            half, odd = divmod(step - 1, 2)
            if step == 1:
                yield 1.0, 1.0
            elif odd:
                m = half
                yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            else:
                m = half
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_x = math.log(x) if x < 0.5 else math.log1p(-rest)
    log_rest = math.log(rest) if rest < 0.5 else math.log1p(-x)
    log_front = a * log_x + b * log_rest - _log_beta(a, b)
    return math.exp(log_front) / a * _lentz(terms(), 0.0)


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0.0:
        return 1.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        for n in range(1, _STEPS):
            term *= x / (a + n)
            total += term
            if term < total * 1e-17:
                return 1.0 - math.exp(log_front) * total
        raise ArithmeticError("A tail probability did not converge.")

    def terms():
        yield 1.0, x + 1.0 - a
        for n in range(1, _STEPS):
            yield -n * (n - a), x + 2 * n + 1.0 - a

    return math.exp(log_front) * _lentz(terms(), 0.0)


def t_two_sided(t: float, df: float) -> float:
    return beta_tail(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))


def f_upper(f: float, df1: float, df2: float) -> float:
    return beta_tail(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f), df1 * f / (df2 + df1 * f))


def chi2_upper(x: float, df: float) -> float:
    return gamma_tail(df / 2.0, x / 2.0)


def t_quantile(probability: float, df: float) -> float:
    """t value whose two-sided tail is ``1 - probability`` (bisection)."""
    low, high = 0.0, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if t_two_sided(middle, df) > 1 - probability else (low, middle)
    return (low + high) / 2


def _vector(function, *columns: pd.Series) -> pd.Series:
    rows = zip(*[pd.to_numeric(c, errors="coerce").to_numpy(dtype=float) for c in columns])
    return pd.Series([function(*row) if np.isfinite(row).all() else None for row in rows], dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_sf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vector(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def f_sf(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _vector(f_upper, f, df1, df2)


@F.pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    return _vector(chi2_upper, x, df)
