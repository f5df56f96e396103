"""Outlier, time-of-day and quantity screens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.stats import fences
from demandloom.operators.joins import drop_listed, lookup_join
from demandloom.operators.ranking import exact_quantiles
from demandloom.schema import DATE, PRICE, PRODUCT, QUANTITY, TX_ID

# Screening rules and the names of the four result sets.
MIN_GROUP_ROWS = 4
FIRST_HOUR, LAST_HOUR = 6, 22
KINDS = ["price_anomalies", "quantity_anomalies", "time_anomalies", "format_anomalies"]

MEASURES = {"price": PRICE, "quantity": QUANTITY}


def iqr_bounds(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, lower_bound, upper_bound) for every group with a value."""
    quartiles = exact_quantiles(df, keys, value, {"q1": 0.25, "q3": 0.75})
    lower, upper = fences(F.col("q1"), F.col("q3"), F.col("smallest"))
    return quartiles.select(
        *keys, "n", lower.alias("lower_bound"), upper.alias("upper_bound")
    )


def add_day_parts(df: DataFrame) -> DataFrame:
    moment = F.col(DATE).cast("timestamp_ntz")
    return df.withColumns(
        {"datetime": moment, "date_only": F.to_date(moment), "hour": F.hour(moment)}
    )


def daily_bounds(df: DataFrame, per: list[str] | None = None) -> DataFrame:
    """Price and quantity bounds per (product, day) from one pass over the rows.

    Columns: product, date_only, then n/lower/upper per measure.
    """
    present = {name: c for name, c in MEASURES.items() if c in df.columns}
    group = [*(per or []), PRODUCT, "date_only"]
    day = F.to_date(F.col(DATE).cast("timestamp_ntz")).alias("date_only")
    long = df.select(
        *(per or []),
        PRODUCT,
        day,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("measure"), F.col(c).cast("double").alias("value"))
                    for name, c in present.items()
                ]
            )
        ).alias("m"),
    ).select(*group, "m.measure", "m.value")
    bounds = iqr_bounds(long, [*group, "measure"], "value")

    def pick(name: str, column: str) -> Column:
        return F.max(F.when(F.col("measure") == name, F.col(column))).alias(f"_{name}_{column}")

    return bounds.groupBy(*group).agg(
        *[
            pick(name, column)
            for name in present
            for column in ("n", "lower_bound", "upper_bound")
        ]
    )


def flag_anomalies(
    df: DataFrame, bounds: DataFrame | None = None, per: list[str] | None = None
) -> DataFrame:
    """Add the day columns and one boolean per kind of anomaly.

    All screens look at the same rows; a row may fail several.  ``bounds``
    replaces the computed (product, day) bounds.
    """
    dated = add_day_parts(df)
    limits = daily_bounds(df, per) if bounds is None else bounds
    joined = lookup_join(dated, limits, [*(per or []), PRODUCT, "date_only"])

    def outside(name: str) -> Column:
        value = F.col(MEASURES[name])
        if MEASURES[name] not in df.columns:
            return F.lit(False)
        beyond = (value < F.col(f"_{name}_lower_bound")) | (value > F.col(f"_{name}_upper_bound"))
        return F.coalesce((F.col(f"_{name}_n") >= MIN_GROUP_ROWS) & beyond, F.lit(False))

    odd_hour = (F.col("hour") < FIRST_HOUR) | (F.col("hour") > LAST_HOUR)
    flags = [
        outside("price"),
        outside("quantity"),
        F.coalesce(odd_hour, F.lit(False)),
        F.coalesce(F.col(QUANTITY) <= 0, F.lit(False)),
    ]
    return joined.select(*dated.columns, *[f.alias(k) for f, k in zip(flags, KINDS)])


def anomaly_set(flagged: DataFrame, kind: str) -> DataFrame:
    """The rows of one kind, with the day columns."""
    return flagged.where(F.col(kind)).drop(*KINDS)


def anomaly_sets(flagged: DataFrame) -> dict[str, DataFrame]:
    return {kind: anomaly_set(flagged, kind) for kind in KINDS}


def anomaly_union(flagged: DataFrame) -> DataFrame:
    """All sets in one table: a row appears once per kind, named in ``anomaly_type``."""
    kinds = F.filter(
        F.array(*[F.when(F.col(k), F.lit(k)) for k in KINDS]), lambda k: k.isNotNull()
    )
    return flagged.withColumn("anomaly_type", F.explode(kinds)).drop(*KINDS)


def is_clean() -> Column:
    """No flag and a known transaction ID (an unknown ID never counts as clean)."""
    condition = F.col(TX_ID).isNotNull()
    for kind in KINDS:
        condition = condition & ~F.col(kind)
    return condition


def clean_rows(flagged: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Rows whose transaction has no anomaly.

    With unique IDs the flags of the row decide; otherwise one flagged row
    removes every row with its ID.
    """
    extra = [*KINDS, "datetime", "date_only", "hour"]
    if unique_ids:
        return flagged.where(is_clean()).drop(*extra)
    any_flag = F.array_contains(F.array(*[F.col(k) for k in KINDS]), True)
    bad = flagged.where(any_flag & F.col(TX_ID).isNotNull())
    return drop_listed(flagged, TX_ID, bad).drop(*extra)


def zscores(df: DataFrame, value: str, keys: list[str], out: str = "zscore") -> DataFrame:
    """(x - mean) / sample deviation per group, 0 where the deviation is 0 or undefined."""
    moments = df.groupBy(*keys).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd")
    )
    spread = F.col("_sd")
    score = F.when(F.coalesce(spread, F.lit(0.0)) == 0, 0.0).otherwise(
        (F.col(value) - F.col("_mean")) / spread
    )
    return lookup_join(df, moments, keys).withColumn(out, score).drop("_mean", "_sd")
