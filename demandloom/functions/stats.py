"""Closed forms for outlier bounds, sample moments and error measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outlier fences are asymmetric.
LOWER_FENCE = 1.5
UPPER_FENCE = 2.0


def lerp(low: Column, high: Column, frac: Column) -> Column:
    """Linear interpolation that is exact at both ends."""
    step = high - low
    return F.when(frac < 0.5, low + step * frac).otherwise(high - step * (1 - frac))


def fences(q1: Column, q3: Column, smallest: Column) -> tuple[Column, Column]:
    """Lower and upper outlier bound.

    With no spread the quartiles themselves are the bounds, and a group without
    negative values never gets a negative lower bound.
    """
    spread = q3 - q1
    lower = q1 - spread * LOWER_FENCE
    lower = F.when(smallest >= 0, F.greatest(lower, F.lit(0.0))).otherwise(lower)
    return (
        F.when(spread == 0, q1).otherwise(lower),
        F.when(spread == 0, q3).otherwise(q3 + spread * UPPER_FENCE),
    )


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness; 0 for a constant group, null below 3 values."""
    n = F.count(value).cast("double")
    g1 = F.when(F.stddev_pop(value) == 0, 0.0).otherwise(F.skewness(value))
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis; 0 for a constant group, null below 4 values."""
    n = F.count(value).cast("double")
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6)
    return F.when(n >= 4, F.when(F.stddev_pop(value) == 0, 0.0).otherwise(corrected))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, F.lit(2))))


def mse(actual: Column, predicted: Column) -> Column:
    return F.avg(F.pow(actual - predicted, F.lit(2)))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over rows with a non-zero actual value."""
    return 100 * F.avg(F.when(actual != 0, F.abs((actual - predicted) / actual)))
