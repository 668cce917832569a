"""Logistic regression on a few numbers per row, fitted by Newton steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows at most, chosen by the hash of their key: the same on every run."""
    n = rows.count()
    share = int(min(1.0, limit / max(n, 1)) * (1 << 20))
    return rows.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 20)) < share)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (the constant last) for standardised columns."""
    if not len(y) or y.min() == y.max():  # nothing to tell apart: the smoothed rate
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return np.zeros(x.shape[1]), np.ones(x.shape[1]), np.append(np.zeros(x.shape[1]), np.log(rate / (1 - rate)))
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])

    def loss(w: np.ndarray) -> float:
        m = z @ w
        return float(np.logaddexp(0, m).sum() - (y * m).sum() + (penalty * w * w).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return mean, scale, w


def margin(columns: list[str], model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Column:
    """The log-odds of a row as a column expression."""
    mean, scale, w = model
    out = F.lit(float(w[-1]))
    for name, m, s, v in zip(columns, mean, scale, w[:-1], strict=True):
        out = out + (F.col(name) - F.lit(float(m))) * F.lit(float(v / s))
    return out


def probability(log_odds: Column) -> Column:
    """The probability of log-odds."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds))
