"""Special functions that Spark lacks: digamma, ln Gamma, Beta quantiles, over columns or arrays."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Steps of the recurrence before the asymptotic series, and the series' terms in 1/y^2.
SHIFT = 10
SERIES = (-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132, 691 / 32760)


def digamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers, to about 1e-14."""
    x = np.asarray(x, float)
    y, out = x + SHIFT, np.zeros_like(x)
    for k in range(SHIFT):
        out -= 1 / (x + k)
    inverse = 1 / (y * y)
    tail = np.zeros_like(x)
    for c in reversed(SERIES):
        tail = (tail + c) * inverse
    return out + np.log(y) - 0.5 / y + tail


def digamma_column(x: Column) -> Column:
    """The same as an expression in the JVM."""
    y = x + F.lit(float(SHIFT))
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0), lambda t, k: t + 1 / (x + k))
    inverse, tail = 1 / (y * y), F.lit(0.0)
    for c in reversed(SERIES):
        tail = (tail + F.lit(c)) * inverse
    return F.log(y) - F.lit(0.5) / y + tail - steps


#: ln Gamma's asymptotic series in odd powers of 1/y, beside Stirling's formula.
GAMMA_SERIES = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma of positive numbers, to about 1e-14 or its own rounding."""
    x = np.asarray(x, float)
    y, product = x + SHIFT, np.ones_like(x)
    for k in range(SHIFT):
        product = product * (1 + x / k if k else x)  # over k!, lest it overflow
    inverse, tail = 1 / (y * y), np.zeros_like(x)
    for c in reversed(GAMMA_SERIES):
        tail = tail * inverse + c
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + tail / y - np.log(product) - math.lgamma(SHIFT)


def log_gamma_column(x: Column) -> Column:
    """The same as an expression in the JVM."""
    y = x + F.lit(float(SHIFT))
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0), lambda t, k: t + F.log(x + k))
    inverse, tail = 1 / (y * y), F.lit(0.0)
    for c in reversed(GAMMA_SERIES):
        tail = tail * inverse + F.lit(c)
    return (y - F.lit(0.5)) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + tail / y - steps


def _fraction(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The incomplete beta function's continued fraction (Lentz), where it converges fast; all arrays at once."""
    tiny = 1e-300
    safe = lambda v: np.where(v == 0, tiny, v)
    c, d = np.ones_like(x), 1 / safe(1 - (a + b) * x / (a + 1))
    h, live = d.copy(), np.ones(x.shape, bool)
    for m in range(1, 10_000):
        before = h
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / safe(1 + top * d)
            c = safe(1 + top / c)
            h = np.where(live, h * c * d, h)
        live = live & (np.abs(h - before) >= 1e-16 * np.abs(h))
        if not live.any():
            break
    return h


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function for arrays (or numbers) that broadcast; a and b positive."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, float) for v in (x, a, b)))
    inside = np.clip(x, 1e-300, 1 - 2**-53)
    front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(inside) + b * np.log1p(-inside))
    swap = inside > (a + 1) / (a + b + 2)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    part = front * _fraction(np.where(swap, 1 - inside, inside), p, q) / p
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.where(swap, 1 - part, part)))[()]


def beta_quantile(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For arrays that broadcast, all at once: Newton's steps, halved brackets where a step leaves its bracket.

    A Beta with b = 0 is a point at 1.
    """
    p, a, b = np.broadcast_arrays(*(np.asarray(v, float) for v in (p, a, b)))
    point = b <= 0
    b = np.where(point, 1.0, b)
    lo, hi = np.zeros(p.shape), np.ones(p.shape)
    x, scale = a / (a + b), log_gamma(a + b) - log_gamma(a) - log_gamma(b)
    for _ in range(200):
        gap = beta_cdf(x, a, b) - p
        lo, hi = np.where(gap < 0, x, lo), np.where(gap < 0, hi, x)
        inside = np.clip(x, 1e-300, 1 - 2**-53)
        slope = np.exp(np.clip(scale + (a - 1) * np.log(inside) + (b - 1) * np.log1p(-inside), -700, 700))
        step = x - gap / slope
        after = np.where((step > lo) & (step < hi), step, (lo + hi) / 2)
        still = np.abs(after - x) > 1e-15 * x
        x = np.where(still, after, x)
        if not still.any():
            break
    return np.where(point, 1.0, x)[()]


@F.pandas_udf(T.StructType([T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())]))
def beta_interval(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """The middle 95 % of Beta(a, b), a batch at once; null where a is null."""
    one, other = a.to_numpy(float, na_value=np.nan), b.to_numpy(float, na_value=np.nan)
    known = ~(np.isnan(one) | np.isnan(other))
    ends = np.full((len(a), 2), np.nan)
    ends[known] = beta_quantile(np.array([[0.025, 0.975]]), one[known, None], other[known, None])
    return pd.DataFrame({k: pd.Series(ends[:, i]).astype(object).where(known, None) for i, k in enumerate(("lower", "upper"))})


def dirichlet_entropy(alpha: np.ndarray) -> float:
    alpha, total = np.asarray(alpha, float), float(np.sum(alpha))
    log_beta = float(log_gamma(alpha).sum()) - math.lgamma(total)
    return log_beta + (total - len(alpha)) * float(digamma(np.array([total]))[0]) - float(((alpha - 1) * digamma(alpha)).sum())


def dirichlet_divergence(alpha: np.ndarray, beta: np.ndarray) -> float:
    """Kullback-Leibler divergence of Dirichlet(alpha) from Dirichlet(beta)."""
    alpha, beta = np.asarray(alpha, float), np.asarray(beta, float)
    gap = digamma(alpha) - digamma(np.array([alpha.sum()]))
    return math.lgamma(alpha.sum()) - float(log_gamma(alpha).sum()) - math.lgamma(beta.sum()) + float(log_gamma(beta).sum()) + float(((alpha - beta) * gap).sum())


def effective_number(share: Column) -> Column:
    """Aggregate: exp of the Shannon entropy of shares; zero shares add nothing."""
    return F.exp(-F.sum(F.when(share > 0, share * F.log(share)).otherwise(0.0)))
