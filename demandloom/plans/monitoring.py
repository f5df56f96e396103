"""Forecast monitoring: error, data drift, concept drift and the retrain decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.drift import ALPHA, concept_drift, data_drift
from demandloom.operators.evaluate import forecast_metrics, pair_forecasts, residuals
from demandloom.operators.series import window_before_latest
from demandloom.schema import DATE, PRODUCT, TOTAL

# Windows in days before the latest date, and the error threshold.
NEW_WINDOW = (13, 7)
REF_WINDOW = (6, 0)
RMSE_THRESHOLD = 20.0


def new_window(daily: DataFrame, date: str = DATE) -> DataFrame:
    return window_before_latest(daily, *NEW_WINDOW, date)


def reference_window(daily: DataFrame, date: str = DATE) -> DataFrame:
    return window_before_latest(daily, *REF_WINDOW, date)


def product_report(daily: DataFrame, predictions: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Per product of the new window: errors and both drift verdicts.

    A product without reference rows counts as not drifted.
    """
    new, ref = new_window(daily), reference_window(daily)
    new_pairs = residuals(pair_forecasts(new, predictions))
    ref_pairs = residuals(pair_forecasts(ref, predictions))
    return (
        new.select(PRODUCT)
        .distinct()
        .join(forecast_metrics(new_pairs).select(PRODUCT, "rmse", "mape"), PRODUCT, "left")
        .join(data_drift(ref, new, [TOTAL], alpha=alpha), PRODUCT, "left")
        .join(concept_drift(ref_pairs, new_pairs, alpha=alpha), PRODUCT, "left")
        .withColumns(
            {
                "data_drift": F.coalesce("data_drift", F.lit(False)),
                "concept_drift": F.coalesce("concept_drift", F.lit(False)),
                "drift_columns": F.coalesce("drift_columns", F.array().cast("array<string>")),
            }
        )
    )


def retrain_decision(report: DataFrame, rmse_threshold: float = RMSE_THRESHOLD) -> DataFrame:
    """One row: mean RMSE over products and whether any product asks for retraining."""
    return report.agg(
        F.avg("rmse").alias("mean_rmse"),
        F.coalesce(F.bool_or(F.col("rmse") > rmse_threshold), F.lit(False)).alias("rmse_exceeded"),
        F.coalesce(F.bool_or("data_drift"), F.lit(False)).alias("data_drift"),
        F.coalesce(F.bool_or("concept_drift"), F.lit(False)).alias("concept_drift"),
    ).withColumn(
        "retrain", F.col("rmse_exceeded") | F.col("data_drift") | F.col("concept_drift")
    )
