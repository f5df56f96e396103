"""Profile statistics and data-quality rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.stats import sample_kurtosis, sample_skewness
from demandloom.functions.text import number_or_null, tidy_name
from demandloom.operators.ranking import exact_quantiles
from demandloom.schema import (
    DATE,
    PRICE,
    PRODUCER,
    PRODUCT,
    QUANTITY,
    REFERENCE_PRODUCTS,
    STORE,
    TOTAL,
    TX_ID,
)

# Statistic names of the profile document, in order.
STATISTICS = [
    "mean",
    "std",
    "min",
    "max",
    "median",
    "25th_percentile",
    "75th_percentile",
    "skewness",
    "kurtosis",
]
QUANTILES = {"median": 0.5, "25th_percentile": 0.25, "75th_percentile": 0.75}


def unpivot_numbers(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column, value) with every listed column as double; no rows without columns."""
    if not columns:
        return df.select(
            *keys, F.lit("").alias("column"), F.lit(None).cast("double").alias("value")
        ).limit(0)
    return df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot(
        keys, columns, "column", "value"
    )


def numeric_stats(
    df: DataFrame,
    columns: list[str] | None = None,
    key: str = PRODUCT,
    per: list[str] | None = None,
) -> DataFrame:
    """One row per (product, column) with the nine profile statistics.

    Columns the table lacks are skipped.  Moments are partial aggregates and the
    quantiles are exact ones that never gather a product in one task.
    """
    wanted = [TOTAL, PRICE] if columns is None else columns
    present = [c for c in wanted if c in df.columns]
    named = df.where(F.col(key).isNotNull())
    keys = [*(per or []), key, "column"]
    long = unpivot_numbers(named, keys[:-1], present)
    value = F.col("value")
    moments = long.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        sample_skewness(value).alias("skewness"),
        sample_kurtosis(value).alias("kurtosis"),
    )
    quantiles = exact_quantiles(long, keys, "value", QUANTILES)
    return moments.join(quantiles, keys, "left").select(*keys, *STATISTICS)


def stats_document(stats: DataFrame, key: str = PRODUCT) -> DataFrame:
    """One JSON text per product: ``{column: {statistic: value}}``.

    The entries of a product are as many as its numeric columns.
    """
    entry = F.struct(F.col("column"), F.struct(*STATISTICS).alias("values"))
    return stats.groupBy(key).agg(
        F.to_json(
            F.map_from_entries(F.array_sort(F.collect_list(entry))),
            {"ignoreNullFields": "false"},
        ).alias("stats")
    )


def quality_profile(df: DataFrame, products: list[str] = REFERENCE_PRODUCTS) -> DataFrame:
    """Rates of the usual defects of raw text transactions, one row per defect.

    Measured: missing values per column, dates not in ISO spelling, repeated
    transaction IDs, negative and zero quantities, numeric store names, unknown
    products, and zero prices on positive quantities.
    """
    quantity = number_or_null(F.col(QUANTITY))
    price = number_or_null(F.col(PRICE))

    text_date = F.col(DATE).cast("string")
    checks: dict[str, Column] = {
        f"null_{name}": F.col(c).isNull()
        for name, c in (
            ("date", DATE),
            ("price", PRICE),
            ("quantity", QUANTITY),
            ("producer", PRODUCER),
            ("store", STORE),
            ("product", PRODUCT),
        )
    }
    checks["non_iso_date"] = ~text_date.rlike(r"^\d{4}-\d{2}-\d{2}")
    checks["negative_quantity"] = quantity < 0
    checks["zero_quantity"] = quantity == 0
    checks["numeric_store"] = F.col(STORE).rlike(r"^\d+$")
    checks["unknown_product"] = ~tidy_name(F.col(PRODUCT)).isin(products)
    checks["free_item"] = (price == 0) & (quantity > 0)

    flagged = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items()],
    ).unpivot(["_rows"], list(checks), "defect", "defect_rows")
    # Only the ID column takes part in the one shuffle this needs.
    repeats = (
        df.groupBy(TX_ID)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("_rows"),
            F.lit("duplicate_id").alias("defect"),
            F.coalesce(
                F.sum(F.when(F.col(TX_ID).isNotNull(), F.col("n") - 1)), F.lit(0)
            ).alias("defect_rows"),
        )
    )
    return flagged.unionByName(repeats).select(
        "defect",
        "defect_rows",
        F.try_divide(F.col("defect_rows").cast("double"), F.col("_rows")).alias("rate"),
    )
