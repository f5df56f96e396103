"""Calendar, lag and rolling features of daily demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.operators.clean import add_calendar_parts
from demandloom.schema import DATE, PRODUCT, TOTAL

# Feature lags and rolling width in rows.
LAGS = [1, 7]
ROLLING = 7


def lag_features(daily: DataFrame, value: str = TOTAL) -> DataFrame:
    """lag_1, lag_7 and rolling_mean_7 per product in date order.

    The input is a daily table, so a product's window holds at most one row per
    calendar day.  The mean needs seven known values.
    """
    series = Window.partitionBy(PRODUCT).orderBy(DATE)
    trailing = series.rowsBetween(-(ROLLING - 1), 0)
    number = F.col(value).cast("double")
    lags = {f"lag_{k}": F.lag(number, k).over(series) for k in LAGS}
    mean = F.when(F.count(number).over(trailing) == ROLLING, F.avg(number).over(trailing))
    return daily.withColumns({**lags, f"rolling_mean_{ROLLING}": mean})


def time_series_features(daily: DataFrame) -> DataFrame:
    """Calendar parts plus lag features.  Without a date column the input comes
    back unchanged; without a quantity it is an error."""
    if DATE not in daily.columns:
        return daily
    if TOTAL not in daily.columns:
        raise KeyError(TOTAL)
    return lag_features(add_calendar_parts(daily))
