"""Price imputation from the most frequent price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.clean import add_week_parts
from demandloom.operators.joins import lookup_join
from demandloom.operators.ranking import most_frequent
from demandloom.schema import DATE, PRICE, PRODUCT
from demandloom.session import stage

# Granularities of the price lookups, finest first.
WEEK = ["Year", "Month", "Week_of_year"]
MONTH = ["Year", "Month"]
YEAR = ["Year"]
MODE = "Most_Frequent_Cost"


def price_counts(
    df: DataFrame, granularity: list[str], per: list[str] | None = None
) -> DataFrame:
    """How often each known price occurs per (granularity, product)."""
    return (
        df.dropna(subset=[PRICE])
        .groupBy(*(per or []), *granularity, PRODUCT, F.col(PRICE).alias(MODE))
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def frequent_price(
    df: DataFrame, granularity: list[str], per: list[str] | None = None
) -> DataFrame:
    """Most frequent known price per (granularity, product); the smaller one on a tie."""
    keys = [*(per or []), *granularity, PRODUCT]
    return most_frequent(price_counts(df, granularity, per), keys, MODE, "_n")


def price_lookup(df: DataFrame, per: list[str] | None = None) -> DataFrame:
    """One row per (week, product) that lacks a price somewhere, with its replacement.

    The rows are read once, into staged weekly price counts; months and years are
    summed from those.  Only weeks with a missing price are kept.
    """
    group = [*(per or []), PRODUCT]
    counts = df.groupBy(*group, *WEEK, F.col(PRICE).alias(MODE)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    weekly = stage(counts, "price-counts")
    known = weekly.where(F.col(MODE).isNotNull())
    result = weekly.where(F.col(MODE).isNull()).select(*group, *WEEK)
    for suffix, level in (("week", WEEK), ("month", MONTH), ("year", YEAR)):
        keys = [*group, *level]
        counts = known.groupBy(*keys, MODE).agg(F.sum("_n").alias("_n"))
        mode = most_frequent(counts, keys, MODE, "_n").withColumnRenamed(MODE, f"_{suffix}")
        result = result.join(mode, keys, "left")
    return result.select(
        *group, *WEEK, F.coalesce("_week", "_month", "_year", F.lit(0.0)).alias("_replacement")
    )


def apply_price_ladder(
    df: DataFrame, week: DataFrame, month: DataFrame, year: DataFrame
) -> DataFrame:
    """Fill missing prices from three given lookup tables, else 0."""
    keyed = df
    for suffix, keys, lookup in (("week", WEEK, week), ("month", MONTH, month), ("year", YEAR, year)):
        keyed = lookup_join(
            keyed, lookup.withColumnRenamed(MODE, f"_{suffix}"), [*keys, PRODUCT]
        )
    return keyed.withColumn(
        PRICE, F.coalesce(PRICE, "_week", "_month", "_year", F.lit(0.0))
    ).select(*df.columns)


def fill_missing_prices(
    df: DataFrame, date: str = DATE, per: list[str] | None = None
) -> DataFrame:
    """Replace a missing price by the product's most frequent price of the week,
    else of the month, else of the year, else 0.  Known prices are untouched and
    only they count.  Only rows without a price are joined; the others stay where they are."""
    dated = add_week_parts(df, date)
    unknown = lookup_join(dated.where(F.col(PRICE).isNull()), price_lookup(dated, per), [*(per or []), PRODUCT, *WEEK])
    filled = unknown.withColumn(PRICE, F.coalesce("_replacement", F.lit(0.0))).select(*df.columns)
    return df.where(F.col(PRICE).isNotNull()).unionByName(filled)
