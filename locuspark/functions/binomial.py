"""Exact binomial tests of grouped counts."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


#: log n! minus its Stirling approximation, of 0..16.
_SMALL = np.array([math.lgamma(k + 1) - (k + 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi) if k else 0.0 for k in range(17)])


def _stirling_error(n: np.ndarray) -> np.ndarray:
    """log n! minus its Stirling approximation."""
    n = np.asarray(n, float)
    big = np.maximum(n, 16.0)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / big**2) / big**2) / big**2) / big
    return np.where(n < 16, _SMALL[np.minimum(n, 16).astype(int)], series)


def _deviance(x: np.ndarray, m: float) -> np.ndarray:
    """x log(x / m) + m - x, without cancellation near x = m."""
    x = np.asarray(x, float)
    e = (x - m) / m
    near = np.abs(e) < 0.05
    s = np.where(near, e, 0.0)
    series = 0.0
    for k in range(13, 1, -1):  # the sum of (-s)^k / (k (k - 1))
        series = -s * series + 1 / (k * (k - 1))
    series = series * s * s
    with np.errstate(divide="ignore", invalid="ignore"):
        far = np.where(x > 0, x * np.log(x / m), 0.0) + m - x
    return np.where(near, m * series, far)


def _log_pmf(n: int, p: float, lo: int, hi: int) -> np.ndarray:
    """Log probabilities of lo..hi successes by saddle points, exact to about 1e-14 for any n."""
    k = np.arange(lo, hi + 1, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where((k > 0) & (k < n), 0.5 * np.log(n / (2 * math.pi * k * (n - k))), 0.0)
        body = _stirling_error(np.array([n])) - _stirling_error(k) - _stirling_error(n - k) - _deviance(k, n * p) - _deviance(n - k, n * (1 - p)) + scale
    return np.where(k == 0, n * math.log1p(-p), np.where(k == n, n * math.log(p), body))


#: Outcomes summed at first, and at most at a time.
_FIRST, _STEP = 1 << 8, 1 << 18


def _tail(n: int, p: float, k: int, up: bool) -> float:
    """Probability of k or more (fewer) successes, away from the mode: added up until the rest is nothing.

    That is after some standard deviations, far fewer than n outcomes, so the sums start short and double.
    """
    total, step = 0.0, _FIRST
    while 0 <= k <= n:
        lo, hi = (k, min(n, k + step - 1)) if up else (max(0, k - step + 1), k)
        part = np.exp(_log_pmf(n, p, lo, hi))
        total += float(part.sum())
        if part[-1 if up else 0] <= total * 1e-18:
            break
        k, step = hi + 1 if up else lo - 1, min(2 * step, _STEP)
    return total


def binomial_p(x: int, n: int, p: float) -> float | None:
    """Two-sided exact p: all outcomes at most as likely as x (within 1e-7); None for p 0 or above 1, n 0 or under x.

    The outcomes are two tails: from x outwards, and on the mode's other side from the first one as unlikely, found by bisection.
    """
    if not (0 < p <= 1) or n <= 0 or n < x:
        return None
    if p == 1:
        return 1.0 if x == n else 0.0
    mode = min(n, int((n + 1) * p))
    limit = float(_log_pmf(n, p, x, x)[0]) + 1e-7
    if float(_log_pmf(n, p, mode, mode)[0]) <= limit:
        return 1.0
    up = x > mode
    lo, hi = (-1, mode) if up else (mode, n + 1)  # the far end is as unlikely, the mode is not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        unlikely = float(_log_pmf(n, p, mid, mid)[0]) <= limit
        if up:
            lo, hi = (mid, hi) if unlikely else (lo, mid)
        else:
            lo, hi = (lo, mid) if unlikely else (mid, hi)
    other = _tail(n, p, lo, False) if up else _tail(n, p, hi, True)
    return float(min(1.0, _tail(n, p, x, up) + other))


def clopper_pearson(x: int, n: int, level: float = 0.95) -> tuple[float, float]:
    """Exact interval of a proportion, from the binomial tails by Newton's steps, and by bisection where one leaves the bracket.

    The tail of x or more successes changes with p by x / p times the probability of x, that of x or fewer by -(n - x) / (1 - p) times it.
    """
    a = (1 - level) / 2

    def tail(p: float, upper: bool) -> float:
        past = x <= n * p if upper else x >= n * p  # the tail holds the mode: it is what the other one leaves
        if past:
            return 1.0 - (_tail(n, p, x - 1, False) if upper else _tail(n, p, x + 1, True))
        return _tail(n, p, x, upper)

    def solve(upper: bool) -> float:
        lo, hi = 0.0, 1.0
        off = 2 * math.sqrt(x * (n - x) / n + 1) / n
        p = min(max(x / n + (-off if upper else off), 0.5 * x / n), 1 - 0.5 * (n - x) / n)  # about where the limit is
        for _ in range(60):
            over = tail(p, upper) - a
            lo, hi = (lo, p) if (over > 0) == upper else (p, hi)
            slope = (x / p if upper else -(n - x) / (1 - p)) * math.exp(float(_log_pmf(n, p, x, x)[0]))
            new = p - over / slope if slope else lo
            new = new if lo <= new <= hi else (lo + hi) / 2
            if abs(new - p) <= 2e-15 * p:
                return new
            p = new
        return p

    return (0.0 if x == 0 else solve(True)), (1.0 if x == n else solve(False))


def binomial_test(df: DataFrame, x: str = "obs", n: str = "n", p: str = "prob", interval: bool = True) -> DataFrame:
    """Add binom_p, and with ``interval`` the estimate and its 95 % limits; null where the test is not defined.

    Rows are few and each takes its time, so all tasks share them.
    """

    def run(batches):
        for b in batches:
            rows = [(int(i), int(j), float(q)) if not (pd.isna(i) or pd.isna(j) or pd.isna(q)) else (0, 0, 0.0) for i, j, q in zip(b[x], b[n], b[p], strict=True)]
            found = [binomial_p(*r) for r in rows]
            b = b.assign(binom_p=pd.Series(found, dtype="float64", index=b.index))
            if interval:
                ci = [clopper_pearson(i, j) if f is not None else (None, None) for f, (i, j, _) in zip(found, rows, strict=True)]
                est = [i / j if j and i <= j and 0 < q <= 1 else None for i, j, q in rows]
                b = b.assign(estimate=pd.Series(est, dtype="float64", index=b.index), ci_low=pd.Series([c[0] for c in ci], dtype="float64", index=b.index), ci_high=pd.Series([c[1] for c in ci], dtype="float64", index=b.index))
            yield b

    extra = ["binom_p double", *(["estimate double", "ci_low double", "ci_high double"] if interval else [])]
    shape = ", ".join([*[f"`{c}` {k}" for c, k in df.dtypes], *extra])
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism).mapInPandas(run, shape)
