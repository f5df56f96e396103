"""p-value of the two-sample Kolmogorov-Smirnov statistic.

One call per (product, column): the samples themselves never reach Python,
only their sizes and the largest distance, as whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

METHODS = ("exact", "asymptotic")


#: Mass that is left out at the edges of the walk; p-values below it times the steps are not resolved.
TINY = 1e-300
#: Steps between two looks at the edges.
TRIM_EVERY = 64


def exact_p(n1: int, n2: int, gap: int) -> float:
    """P(n1*n2*D >= gap) under equal distributions.

    Merging the sorted samples is a random walk from (0, 0) to (n1, n2); the
    p-value is the probability that it ever leaves |i*n2 - j*n1| < gap.  Mass is
    moved step by step and taken out where it leaves, so small p-values keep
    their precision.  After ``s`` steps the band is |i*(n1+n2) - s*n1| < gap: only its
    2*gap/(n1+n2) places are kept, and of a wide band only those with mass.
    """
    if gap <= 0:
        return 1.0
    total = n1 + n2
    low, mass, left = 0, np.ones(1), 0.0
    for step in range(total):
        i = np.arange(low, low + len(mass), dtype=np.float64)
        moved = np.zeros(len(mass) + 1)
        moved[:-1] = mass * ((n2 - step) + i)
        moved[1:] += mass * (n1 - i)
        moved /= total - step
        middle = (step + 1) * n1
        first = max(0, (middle - gap) // total + 1 - low)
        end = min(len(moved), -((-middle - gap) // total) - low)
        left += float(moved[:first].sum()) + float(moved[max(end, first) :].sum())
        mass, low = moved[first:end], low + first
        if step % TRIM_EVERY == 0:
            held = np.flatnonzero(mass > TINY)
            if not len(held):
                break
            mass, low = mass[held[0] : held[-1] + 1], low + int(held[0])
    return min(1.0, left)


def asymptotic_p(n1: int, n2: int, d: float) -> float:
    """Kolmogorov series with the usual correction for finite samples."""
    root = math.sqrt(n1 * n2 / (n1 + n2))
    z = (root + 0.12 + 0.11 / root) * d
    if z < 0.2:
        return 1.0
    terms = (2 * (-1) ** (k - 1) * math.exp(-2 * (k * z) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, sum(terms)))


def ks_p_value(n1: Column | str, n2: Column | str, gap: Column | str, method: str = "exact") -> Column:
    """The p-value by the method the caller names, whatever the sample sizes.

    ``exact`` takes time in proportion to the cells of the band, 2 * gap at most, and memory for
    one step of it; ``asymptotic`` is immediate and good for thousands of values.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")

    def one(a, b, g):
        if pd.isna(a) or pd.isna(b) or pd.isna(g) or a < 1 or b < 1:
            return None
        a, b, g = int(a), int(b), int(g)
        return exact_p(a, b, g) if method == "exact" else asymptotic_p(a, b, g / (a * b))

    @F.pandas_udf(T.DoubleType())
    def p_values(n1: pd.Series, n2: pd.Series, gap: pd.Series) -> pd.Series:
        return pd.Series([one(*row) for row in zip(n1, n2, gap)], dtype="float64")

    return p_values(n1, n2, gap)
