"""Price and demand calculations on tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.dates import is_weekend
from demandloom.operators.joins import lookup_join
from demandloom.operators.ranking import block_start, number_rows
from demandloom.schema import DATE, PRODUCT

# Yearly inflation in percent, business hours, influence strength.
INFLATION_RATES = {
    2000: 3.4,
    2001: 2.8,
    2002: 1.6,
    2003: 2.3,
    2004: 2.7,
    2005: 3.4,
    2006: 3.2,
    2007: 2.9,
    2008: 3.8,
    2009: -0.4,
    2010: 1.6,
    2011: 3.2,
    2012: 2.1,
    2013: 1.5,
    2014: 1.6,
    2015: 0.1,
    2016: 1.3,
    2017: 2.1,
    2018: 2.4,
    2019: 1.8,
    2020: 1.2,
    2021: 4.7,
    2022: 8.0,
    2023: 4.1,
    2024: 2.9,
}
OPENING_HOUR, CLOSING_HOUR = 8, 20
INFLUENCE_STRENGTH = 0.5

ROWS_PER_BLOCK = 100_000


def inflation_factor(
    start_year: Column, year: Column, rates: dict[int, float] = INFLATION_RATES
) -> Column:
    """Compound growth over the years after ``start_year`` up to ``year``.

    1 when ``year`` is not later; an error when a rate in between is missing.
    """
    # Index of every year within its run of consecutive years with a rate.
    years = sorted(rates)
    run, level, entries = 0, 1.0, []
    for i, y in enumerate(years):
        if i and y != years[i - 1] + 1:
            run, level = run + 1, 1.0
        before, level = level, level * (1 + rates[y] / 100)
        entries += [
            F.lit(y),
            F.struct(F.lit(run).alias("run"), F.lit(before).alias("before"), F.lit(level).alias("level")),
        ]
    table = F.create_map(*entries)
    first, last = F.try_element_at(table, start_year + 1), F.try_element_at(table, year)
    growth = F.when(first["run"] == last["run"], last["level"] / first["before"])
    missing = F.raise_error(
        F.concat(F.lit("no inflation rate for every year up to "), year.cast("string"))
    ).cast("double")
    return F.when(year <= start_year, 1.0).otherwise(F.coalesce(growth, missing))


def inflation_price(
    price: Column, start_year: Column, year: Column, rates: dict[int, float] = INFLATION_RATES
) -> Column:
    return F.round(price * inflation_factor(start_year, year, rates), 2)


def base_price(override: Column, default: Column) -> Column:
    return F.round(F.coalesce(override, default), 2)


def demand_to_long(wide: DataFrame, products: list[str], date: str = DATE) -> DataFrame:
    """(date, product, demand) rows of a wide table with positive demand."""
    return wide.unpivot([date], products, PRODUCT, "demand").where(F.col("demand") > 0)


def demand_to_wide(long: DataFrame, products: list[str], date: str = DATE) -> DataFrame:
    return long.groupBy(date).pivot(PRODUCT, products).agg(F.sum("demand"))


def spread_over_day(
    df: DataFrame, day: str, seq: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Even timestamps from opening to closing hour, both included, in ``seq`` order.

    ``seq`` is a unique whole number; a day with any number of rows is numbered
    block by block.
    """
    numbered = number_rows(df, [day], seq, block_start(F.col(seq), rows_per_block), "_nth")
    span = (CLOSING_HOUR - OPENING_HOUR) * 3_600_000_000
    share = F.when(
        F.col("_nth_total") > 1,
        F.round(
            F.lit(span).cast("decimal(20,0)") * (F.col("_nth") - 1) / (F.col("_nth_total") - 1)
        ),
    ).otherwise(0)
    opening = F.timestamp_add(
        "HOUR", F.lit(OPENING_HOUR), F.col(day).cast("date").cast("timestamp_ntz")
    )
    return numbered.withColumn(
        "timestamp", F.timestamp_add("MICROSECOND", share.cast("long"), opening)
    ).drop("_nth", "_nth_total")


def price_influence(
    prices: DataFrame, price: str, strength: float = INFLUENCE_STRENGTH, key: str = PRODUCT
) -> DataFrame:
    """Price relative to the product's mean, times ``strength``."""
    mean = prices.groupBy(key).agg(F.avg(price).alias("_mean"))
    return lookup_join(prices, mean, [key]).withColumn(
        "influence", F.col(price) / F.col("_mean") * strength
    ).drop("_mean")


def weekday_slot(date: Column, start: Column) -> Column:
    """Position 0-6 in a weekly pattern that starts at ``start``."""
    return F.pmod(F.date_diff(date, start), F.lit(7))


def weekend_shock(date: Column, magnitude: Column) -> Column:
    """Shock factor: the magnitude on weekends, else 1."""
    return F.when(is_weekend(date), F.coalesce(magnitude, F.lit(1.0))).otherwise(1.0)


def compose_demand(
    base: Column, influence: Column, weekly: Column, shock: Column, noise: Column
) -> Column:
    """Whole, non-negative demand from its factors (halves round to even)."""
    raw = base * (1 + influence) * weekly * shock + noise
    return F.rint(F.greatest(raw, F.lit(0.0))).cast("long")
