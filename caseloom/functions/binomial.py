"""Exact (Clopper-Pearson) limits for a proportion.

Spark has no inverse beta, so this is the one place that needs Python: an Arrow
batch function over small aggregates.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# executors need numpy and pandas but not this package: its functions travel with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ln_gamma(a: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in a], dtype=float)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta, modified Lentz evaluation."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    # terms needed grow like sqrt(max(a, b))
    for m in range(1, 400 + int(4 * math.sqrt(float(np.max(a + b, initial=1.0))))):
        for coef in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + coef * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + coef / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return h


def _ln_density(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Log of x(1 - x) times the beta density."""
    return _ln_gamma(a + b) - _ln_gamma(a) - _ln_gamma(b) + a * np.log(x) + b * np.log1p(-x)


def beta_cdf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta for 0 < x < 1, element by element."""
    swap = x > (a + 1.0) / (a + b + 2.0)
    aa, bb, xx = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    p = np.exp(_ln_density(aa, bb, xx)) * _beta_fraction(aa, bb, xx) / aa
    return np.where(swap, 1.0 - p, p)


def beta_quantile(p: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Newton steps kept inside a shrinking bracket; a step that leaves it is a bisection."""
    lo, hi = np.zeros_like(a), np.ones_like(a)
    mean = a / (a + b)
    spread = np.sqrt(mean * (1 - mean) / (a + b + 1))
    x = np.clip(mean + (2 if p > 0.5 else -2) * spread, 1e-12, 1 - 1e-12)
    for _ in range(200):
        gap = beta_cdf(a, b, x) - p
        lo, hi = np.where(gap < 0, x, lo), np.where(gap < 0, hi, x)
        density = np.exp(_ln_density(a, b, x)) / (x * (1 - x))
        with np.errstate(over="ignore"):
            step = x - gap / np.where(density > 0, density, np.inf)
        inside = (density > 0) & (step > lo) & (step < hi)
        new = np.where(inside, step, (lo + hi) / 2)
        done = np.all(np.abs(new - x) <= 1e-12 * np.maximum(x, 1e-3))
        x = new
        if done:
            break
    return x


def exact_limits(x: np.ndarray, n: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    x, n = np.asarray(x, dtype=float), np.asarray(n, dtype=float)
    lower, upper = np.full(x.shape, np.nan), np.full(x.shape, np.nan)
    lower[(n > 0) & (x == 0)] = 0.0
    upper[(n > 0) & (x == n)] = 1.0
    i = (n > 0) & (x > 0)
    lower[i] = beta_quantile(alpha / 2, x[i], n[i] - x[i] + 1)
    j = (n > 0) & (x < n)
    upper[j] = beta_quantile(1 - alpha / 2, x[j] + 1, n[j] - x[j])
    return lower, upper


def binomial_limits(alpha: float = 0.05) -> Callable[[Column, Column], Column]:
    """Column function ``(x, n) -> struct<lower, upper>``."""

    @F.pandas_udf("lower double, upper double")
    def limits(x: pd.Series, n: pd.Series) -> pd.DataFrame:
        lower, upper = exact_limits(x.to_numpy(float), n.to_numpy(float), alpha)
        return pd.DataFrame({"lower": lower, "upper": upper})

    return limits
