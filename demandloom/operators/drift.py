"""Distribution drift between two windows of data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.ks import ks_p_value
from demandloom.operators.profile import unpivot_numbers
from demandloom.operators.ranking import cumulate, histogram
from demandloom.schema import PRODUCT

# Significance level and smallest sample that is tested.
ALPHA = 0.05
MIN_SAMPLE = 2


def numeric_columns(df: DataFrame, keys: list[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in keys
    ]


def ks_statistics(ref: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column, n_ref, n_new, gap, ks_statistic) for both samples of every column.

    ``gap`` is the largest distance of the two step functions times
    ``n_ref * n_new``, a whole number.  Equal values are counted before anything
    is sorted, and the running counts are taken over value buckets, so neither a
    hot product nor a hot value ends up in one task.
    """
    group = [*keys, "column"]
    both = (
        unpivot_numbers(ref, keys, columns)
        .withColumn("_new", F.lit(0))
        .unionByName(unpivot_numbers(new, keys, columns).withColumn("_new", F.lit(1)))
    )
    counts = histogram(
        both.where(~F.isnan("value")),
        group,
        "value",
        F.count_if(F.col("_new") == 0).alias("ref"),
        F.count_if(F.col("_new") == 1).alias("new"),
    )
    steps = cumulate(counts, group, ["ref", "new"])

    def exact(name: str):
        return F.col(name).cast("decimal(19,0)")

    distance = F.abs(
        exact("ref_cum") * exact("new_all") - exact("new_cum") * exact("ref_all")
    ).cast("decimal(38,0)")
    return (
        steps.groupBy(*group)
        .agg(
            F.max("ref_all").alias("n_ref"),
            F.max("new_all").alias("n_new"),
            F.max(distance).alias("gap"),
        )
        .withColumn(
            "ks_statistic",
            F.try_divide(
                F.col("gap").cast("double"), F.col("n_ref").cast("double") * F.col("n_new")
            ),
        )
    )


def ks_drift(
    ref: DataFrame,
    new: DataFrame,
    keys: list[str],
    columns: list[str],
    alpha: float = ALPHA,
    method: str = "exact",
) -> DataFrame:
    """Adds method, p_value and drift to the statistics; too small samples are left out.

    ``method`` names the distribution of the p-value, ``exact`` or ``asymptotic``; it never
    depends on the sample size.
    """
    stats = ks_statistics(ref, new, keys, columns).where(
        (F.col("n_ref") >= MIN_SAMPLE) & (F.col("n_new") >= MIN_SAMPLE)
    )
    tested = stats.withColumn("method", F.lit(method)).withColumn(
        "p_value", ks_p_value("n_ref", "n_new", F.col("gap").cast("double"), method)
    )
    return tested.withColumn("drift", F.col("p_value") < alpha)


def data_drift(
    ref: DataFrame,
    new: DataFrame,
    columns: list[str] | None = None,
    keys: list[str] | None = None,
    alpha: float = ALPHA,
    method: str = "exact",
) -> DataFrame:
    """Per product: whether any numeric column drifted, and which ones.

    Columns default to the numeric ones of ``ref``; a column ``new`` lacks is
    skipped.
    """
    keys = [PRODUCT] if keys is None else keys
    wanted = numeric_columns(ref, keys) if columns is None else columns
    shared = [c for c in wanted if c in new.columns]
    tested = ks_drift(ref, new, keys, shared, alpha, method)
    drifted = F.collect_set(F.when(F.col("drift"), F.col("column")))
    return tested.groupBy(*keys).agg(
        F.bool_or("drift").alias("data_drift"), F.array_sort(drifted).alias("drift_columns")
    )


def concept_drift(
    ref_residuals: DataFrame,
    new_residuals: DataFrame,
    keys: list[str] | None = None,
    alpha: float = ALPHA,
    column: str = "residual",
    method: str = "exact",
) -> DataFrame:
    """Per product: whether the forecast errors of the two windows differ."""
    keys = [PRODUCT] if keys is None else keys
    tested = ks_drift(ref_residuals, new_residuals, keys, [column], alpha, method)
    return tested.select(*keys, F.col("drift").alias("concept_drift"))
