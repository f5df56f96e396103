"""Typing, string and filter steps of the cleaning job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.dates import calendar_parts, parse_mixed_date, week_parts
from demandloom.functions.text import tidy_name
from demandloom.operators.joins import keep_listed
from demandloom.schema import DATE, PRODUCT, QUANTITY, REFERENCE_PRODUCTS, SOURCE_FILE, TYPED


def coerce_types(df: DataFrame) -> DataFrame:
    """Cast the known columns that are present; a bad value raises.

    Quantity goes through double and is rounded half away from zero.
    """
    casts: dict[str, Column] = {}
    for field in TYPED.fields:
        if field.name not in df.columns:
            continue
        col = F.col(f"`{field.name}`")
        if field.name == QUANTITY:
            col = F.round(col.cast("double"), 0)
        casts[field.name] = col.cast(field.dataType)
    return df.withColumns(casts)


def lowercase_strings(df: DataFrame, skip: tuple[str, ...] = (SOURCE_FILE,)) -> DataFrame:
    """Lower-case every string column, identifiers included; file paths stay."""
    return df.withColumns(
        {
            f.name: F.lower(F.col(f"`{f.name}`"))
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip
        }
    )


def tidy_products(df: DataFrame, column: str = PRODUCT) -> DataFrame:
    return df.withColumn(column, tidy_name(F.col(column)))


def standardize_dates(df: DataFrame, column: str = DATE) -> DataFrame:
    """Parse a text date column; other types and absent columns pass unchanged."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.StringType):
        return df
    return df.withColumn(column, parse_mixed_date(F.col(column)))


def add_week_parts(df: DataFrame, column: str = DATE) -> DataFrame:
    return df.withColumns(week_parts(F.col(column)))


def add_calendar_parts(df: DataFrame, column: str = DATE) -> DataFrame:
    return df.withColumns(calendar_parts(F.col(column))) if column in df.columns else df


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows without a quantity or without a product."""
    return df.dropna(subset=[QUANTITY, PRODUCT])


def keep_products(
    df: DataFrame,
    allowed: list[str] | DataFrame = REFERENCE_PRODUCTS,
    column: str = PRODUCT,
    observation: Observation | None = None,
) -> DataFrame:
    """Keep rows of known products; a null product is dropped.

    With an ``observation`` the rows seen and the rows removed are reported
    once an action ran; no extra pass is made.  For a table of products only
    the rows seen are reported.
    """
    if observation is not None:
        measures = [F.count(F.lit(1)).alias("rows_seen")]
        if not isinstance(allowed, DataFrame):
            listed = F.coalesce(F.col(column).isin(allowed), F.lit(False))
            measures.append(F.count_if(~listed).alias("rows_removed"))
        df = df.observe(observation, *measures)
    return keep_listed(df, column, allowed)
