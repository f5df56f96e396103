"""Dickey-Fuller regressions and their p-values, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Response surface of MacKinnon (1994) for one series with a constant.
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
SMALL_P = [2.1659, 1.4412, 0.038269]
LARGE_P = [1.7339, 0.93202, -0.12745, -0.010368]

SIGNIFICANCE = 0.05


def regression_t(dy: Column, lagged: Column) -> Column:
    """t statistic of the slope in dy = a + b * lagged, from regression sums."""
    n, sxx = F.regr_count(dy, lagged), F.regr_sxx(dy, lagged)
    sxy, syy = F.regr_sxy(dy, lagged), F.regr_syy(dy, lagged)
    rest = syy - F.try_divide(sxy * sxy, sxx)
    variance = F.when(n > 2, rest / (n - 2))
    return F.when(
        (sxx > 0) & (variance > 0), F.try_divide(sxy, sxx) / F.sqrt(F.try_divide(variance, sxx))
    )


def normal_cdf(x: Column) -> Column:
    """Distribution function of the standard normal: a power series, a continued fraction in the tails."""
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    powers = F.sequence(F.lit(1), F.lit(80))
    series = F.aggregate(
        powers,
        F.struct(x.alias("t"), x.alias("s")),
        lambda a, k: F.struct((a["t"] * x * x / (2 * k + 1)).alias("t"), (a["s"] + a["t"] * x * x / (2 * k + 1)).alias("s")),
        lambda a: a["s"],
    )
    far = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), F.abs(x), lambda a, k: F.abs(x) + k / a)
    tail = density / far
    return F.when(x < -4, tail).when(x > 4, 1 - tail).otherwise(0.5 + density * series)


def mackinnon_p(tau: Column) -> Column:
    """Approximate p-value of a Dickey-Fuller statistic (constant, no trend); null stays null."""

    def surface(coefficients: list[float]) -> Column:
        total = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            total = total * tau + c
        return total

    inside = normal_cdf(F.when(tau <= TAU_STAR, surface(SMALL_P)).otherwise(surface(LARGE_P)))
    return F.when(tau > TAU_MAX, 1.0).when(tau < TAU_MIN, 0.0).when(tau.isNotNull(), inside)


def most_lags(n: Column) -> Column:
    """The largest lag order that a series of n values is tested with."""
    return F.least(F.ceil(12 * F.pow(n / 100.0, F.lit(0.25))), F.floor(n / 2) - 2).cast("int")
