"""Tail probabilities (chi-squared, Student t, F) for test statistics.

These run on result rows only (one row per test), through a vectorised pandas UDF; the
statistics themselves are computed by Spark aggregations. Series / continued-fraction
evaluations of the regularised incomplete gamma and beta functions.
"""

from __future__ import annotations

import sys

import math

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# UDF code from this module is shipped to Python workers by value, so executors do not
# need the package installed (the driver may run from anywhere).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPS = 1e-15
_TINY = 1e-300


def _steps(*params: float) -> int:
    """Terms needed grow with the root of the parameters; a bound well above that."""
    return 2_000 + int(60.0 * math.sqrt(max(1.0, *params)))


def _gamma_p_series(a: float, x: float) -> float:
    """P(a, x) as x^a e^-x / Gamma(a) times the sum of x^k / (a (a+1) ... (a+k)); NaN if it does not converge."""
    part = total = 1.0 / a
    for k in range(1, _steps(a, x)):
        part *= x / (a + k)
        total += part
        if part < total * _EPS:
            return total * math.exp(a * math.log(x) - x - math.lgamma(a))
    return math.nan


def _fraction(terms, steps: int) -> float:
    """Continued fraction 1 / (b0 + a1 / (b1 + a2 / (b2 + ...))) from (b0, and then a, b), evaluated forwards as a
    product of ratios of successive convergents; NaN if it does not converge."""
    (_, b0), rest = next(terms), terms
    num, den = b0 or _TINY, 0.0
    value = 1.0 / num
    den = 1.0 / num
    ahead = b0 + 1.0 / _TINY
    for _, (a, b) in zip(range(steps), rest):
        den = 1.0 / ((b + a * den) or _TINY)
        ahead = (b + a / ahead) or _TINY
        ratio = ahead * den
        value *= ratio
        if abs(ratio - 1.0) < _EPS:
            return value
    return math.nan


def _gamma_q_cf(a: float, x: float) -> float:
    def terms():
        yield 0.0, x + 1.0 - a
        k = 1
        while True:
            yield -k * (k - a), x + 2.0 * k + 1.0 - a
            k += 1

    return math.exp(a * math.log(x) - x - math.lgamma(a)) * _fraction(terms(), _steps(a, x))


def gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gamma_p_series(a, x)
    return _gamma_q_cf(a, x)


def _beta_cf(a: float, b: float, x: float) -> float:
    def terms():
        yield 0.0, 1.0
        m = 0
        while True:
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            m += 1
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return _fraction(terms(), 2 * _steps(a, b))


def beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1.0 - x) / b


def chi2_sf(x: float, df: float) -> float:
    if x is None or df is None or df <= 0 or math.isnan(x):
        return float("nan")
    return gamma_q(df / 2.0, max(x, 0.0) / 2.0)


def t_two_sided(t: float, df: float) -> float:
    if t is None or df is None or df <= 0 or math.isnan(t):
        return float("nan")
    return beta_i(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or d1 is None or d2 is None or d1 <= 0 or d2 <= 0 or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    return beta_i(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@F.pandas_udf(T.DoubleType())
def _chi2_sf_udf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(a, b) for a, b in zip(x, k)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _t_udf(t: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t, k)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _f_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(a, b, c) for a, b, c in zip(f, d1, d2)], dtype="float64")


def chi2_pvalue(stat: Column, df: Column) -> Column:
    return _chi2_sf_udf(stat.cast("double"), df.cast("double"))


def t_pvalue(t: Column, df: Column) -> Column:
    return _t_udf(t.cast("double"), df.cast("double"))


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    return _f_udf(f.cast("double"), d1.cast("double"), d2.cast("double"))
