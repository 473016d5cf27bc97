"""p-values of the two-sample Kolmogorov-Smirnov distance."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_TERMS = 100


def asymptotic_p(distance: Column, n_ref: Column, n_cur: Column) -> Column:
    """Limiting distribution with the finite-sample shift of Vrbik (2018).

    The effective size is the rounded harmonic size nm/(n+m), as for a
    one-sample test of that size.
    """
    n, m = n_ref.cast("double"), n_cur.cast("double")
    size = F.greatest(F.rint(n * m / (n + m)), F.lit(1.0))
    root = F.sqrt(size)
    plain = distance * root
    lam = plain + 1 / (6 * root) + (plain - 1) / (4 * size)
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(2 * terms, F.lit(0.0)), F.lit(1.0)))


def exact_two_sample_p(distance: float, n: int, m: int) -> float:
    """Chance that a random interleaving of n and m values reaches the distance.

    Walks the interleaving one value at a time. ``mass[i]`` is the chance that
    i of the first t values came from the first sample and that the distance
    was never reached; the mass that reaches it is taken out and summed up.
    """
    height = int(round(distance * n * m))
    if height <= 0:
        return 1.0
    mass = np.zeros(n + 1)
    mass[0] = 1.0
    reached = 0.0
    low = high = 0
    for t in range(n + m):
        i = np.arange(low, high + 1)
        here = mass[low : high + 1]
        first = here * (n - i) / (n + m - t)
        second = here * (m - (t - i)) / (n + m - t)
        top = min(high + 1, n)
        nxt = np.zeros(top - low + 1)
        nxt[: len(second)] += second
        nxt[1 : len(first) + 1] += first[: top - low]
        k = np.arange(low, top + 1)
        out = np.abs(k * m - (t + 1 - k) * n) >= height
        if out.any():
            reached += nxt[out].sum()
            nxt[out] = 0.0
        alive = np.flatnonzero(nxt)
        if alive.size == 0:
            return float(min(1.0, reached))
        mass[low : top + 1] = nxt
        low, high = low + int(alive[0]), low + int(alive[-1])
    return float(min(1.0, reached))


def exact_equal_sizes_p(height: int, n: int) -> float:
    """The same for two samples of n values whose running counts differ by ``height`` at most: n / height terms."""
    if height <= 0:
        return 1.0
    middle = 2 * math.lgamma(n + 1)
    total = 0.0
    for j in range(1, n // height + 1):
        term = math.exp(middle - math.lgamma(n + 1 - j * height) - math.lgamma(n + 1 + j * height))
        if term == 0.0:
            break
        total += 2 * term if j % 2 else -2 * term
    return min(max(total, 0.0), 1.0)


@F.pandas_udf(T.DoubleType())
def exact_p(distance: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    """One value per tested column (not per data row)."""
    return pd.Series(
        [
            exact_equal_sizes_p(round(d * n), int(n)) if n == m else exact_two_sample_p(d, int(n), int(m))
            for d, n, m in zip(distance, n_ref, n_cur)
        ]
    )
