"""Daily demand and related aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.schema import DATE, PRODUCT, QUANTITY, TOTAL


def daily_demand(df: DataFrame, per: list[str] | None = None) -> DataFrame:
    """Quantity per (day, product).  Sort at the output, not here."""
    return df.groupBy(*(per or []), F.to_date(F.col(DATE)).alias(DATE), PRODUCT).agg(
        F.coalesce(F.sum(QUANTITY), F.lit(0)).alias(TOTAL)
    )


def sorted_daily(df: DataFrame) -> DataFrame:
    return df.orderBy(DATE, PRODUCT)


def sum_by_day(daily: DataFrame) -> DataFrame:
    """One row per (product, day) for daily tables that may repeat a day."""
    return daily.groupBy(PRODUCT, F.to_date(F.col(DATE)).alias(DATE)).agg(
        F.sum(TOTAL).alias(TOTAL)
    )


def date_span(df: DataFrame, keys: list[str], date: str = DATE) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))
