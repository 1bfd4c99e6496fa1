"""Student t tail probabilities for small result tables.

Spark has no t distribution function.  The two-sided p value is the
regularised incomplete beta I_x(df/2, 1/2) at x = df / (df + t^2), evaluated
with a continued fraction (modified Lentz) on numpy arrays inside an
Arrow-batched pandas UDF.  It is applied only to tables of group pairs,
never to raw rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_EPS = 1e-15
_TINY = 1e-300
_LGAMMA = np.frompyfunc(math.lgamma, 1, 1)


def _beta_cf(a: np.ndarray, b: np.ndarray, x: np.ndarray, iters: int = 300) -> np.ndarray:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1.0) < _EPS):
            break
    return h


def regularized_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """I_x(a, b) for arrays, 0 <= x <= 1."""
    x, a, b = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(x, a, b))
    out = np.full_like(x, np.nan)
    ok = (x >= 0) & (x <= 1) & (a > 0) & (b > 0)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    inner = ok & (x > 0) & (x < 1)
    if inner.any():
        xi, ai, bi = x[inner], a[inner], b[inner]
        ln_front = (
            _LGAMMA(ai + bi).astype(float) - _LGAMMA(ai).astype(float) - _LGAMMA(bi).astype(float)
            + ai * np.log(xi) + bi * np.log1p(-xi)
        )
        front = np.exp(ln_front)
        direct = xi < (ai + 1.0) / (ai + bi + 2.0)
        res = np.empty_like(xi)
        if direct.any():
            res[direct] = front[direct] * _beta_cf(ai[direct], bi[direct], xi[direct]) / ai[direct]
        flip = ~direct
        if flip.any():
            res[flip] = 1.0 - front[flip] * _beta_cf(bi[flip], ai[flip], 1.0 - xi[flip]) / bi[flip]
        out[inner] = res
    return out


def t_two_sided_p_values(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) for Student t with ``df`` degrees of freedom."""
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return regularized_beta(df / (df + t * t), df / 2.0, np.full_like(df, 0.5))


def _t_p_batch(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided_p_values(t.to_numpy(dtype=float, na_value=np.nan), df.to_numpy(dtype=float, na_value=np.nan)))


def t_p_value(t: Column | str, df: Column | str) -> Column:
    """Two-sided p value of a t statistic (Arrow-batched, for small tables only)."""
    udf = F.pandas_udf(_t_p_batch, "double")
    return udf(F.col(t) if isinstance(t, str) else t, F.col(df) if isinstance(df, str) else df)
