"""Tail probabilities and quantiles, vectorized over small aggregated results (numpy; used in pandas UDFs)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.vectorize(math.lgamma, otypes=[float])(x)


def inc_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularized incomplete beta function by its continued fraction (modified Lentz)."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    flip = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.clip(np.where(flip, 1 - x, x), 0, 1)
    tiny = 1e-300
    with np.errstate(all="ignore"):
        front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
        c = np.ones_like(z)
        d = 1 / np.where(np.abs(1 - (p + q) * z / (p + 1)) < tiny, tiny, 1 - (p + q) * z / (p + 1))
        h = d.copy()
        for m in range(1, 300):
            for even in (True, False):
                num = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)) if even else -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
                d = 1 + num * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + num / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                h = h * d * c
        part = np.where(z <= 0, 0.0, np.where(z >= 1, 1.0, front * h))
    return np.where(flip, 1 - part, part)


def t_upper(t, df) -> np.ndarray:
    """P(T > t) of Student's t with df degrees of freedom."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    half = 0.5 * inc_beta(df / 2, np.full_like(df, 0.5), df / (df + t * t))
    return np.where(t >= 0, half, 1 - half)


def chi2_upper(x, df) -> np.ndarray:
    """P(X > x) of chi-squared: upper incomplete gamma by series or continued fraction."""

    def one(v: float, k: float) -> float:
        if not (v == v and k > 0):
            return math.nan
        s, z = k / 2, v / 2
        if z <= 0:
            return 1.0
        front = math.exp(s * math.log(z) - z - math.lgamma(s))
        if z < s + 1:
            term = total = 1 / s
            for n in range(1, 1000):
                term *= z / (s + n)
                total += term
                if term < total * 1e-15:
                    break
            return max(0.0, 1 - front * total)
        b = z + 1 - s
        c, d = 1e300, 1 / b
        h = d
        for n in range(1, 1000):
            an = -n * (n - s)
            b += 2
            d = 1 / (an * d + b or 1e-300)
            c = b + an / c or 1e-300
            h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return front * h

    return np.vectorize(one, otypes=[float])(np.asarray(x, float), np.asarray(df, float))


def _udf(function, *args: Column) -> Column:
    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series) -> pd.Series:
        ok = a.notna() & b.notna()
        out = pd.Series(np.nan, index=a.index)
        if ok.any():
            out[ok] = function(a[ok].to_numpy(float), b[ok].to_numpy(float))
        return out.where(out.notna(), None).astype("object")

    return tail(*args)


def t_upper_col(t: Column, df: Column) -> Column:
    """P(T > t) as a column; null where t or df is."""
    return _udf(t_upper, t.cast("double"), df.cast("double"))


def chi2_upper_col(x: Column, df: Column) -> Column:
    """P(X > x) of chi-squared as a column."""
    return _udf(chi2_upper, x.cast("double"), df.cast("double"))


# Coefficients of a rational approximation of the normal quantile (Acklam 2003), for the centre and for the edges.
LOW_P = 0.02425
CENTRE = (
    (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00),
    (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01),
)
EDGE = (
    (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00),
    (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00),
)


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    made = F.lit(coefficients[0])
    for c in coefficients[1:]:
        made = made * x + F.lit(c)
    return made


def normal_quantile_col(p: Column) -> Column:
    """Standard normal quantile as a column, to nine digits; null outside (0, 1)."""
    edge = lambda u: _polynomial(EDGE[0], u) / _polynomial((*EDGE[1], 1.0), u)
    q = p - 0.5
    centre = _polynomial(CENTRE[0], q * q) * q / _polynomial((*CENTRE[1], 1.0), q * q)
    inside = F.when(p < LOW_P, edge(F.sqrt(-2 * F.log(p)))).when(p > 1 - LOW_P, -edge(F.sqrt(-2 * F.log1p(-p)))).otherwise(centre)
    return F.when((p > 0) & (p < 1), inside)


def normal_upper_col(z: Column) -> Column:
    """P(Z > z) of the standard normal as a column."""
    upper = np.vectorize(lambda v: 0.5 * math.erfc(v / math.sqrt(2)), otypes=[float])
    return _udf(lambda v, _: upper(v), z.cast("double"), F.lit(0.0))
