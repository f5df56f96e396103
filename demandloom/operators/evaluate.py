"""Forecast error measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.stats import mae, mape, mse, rmse
from demandloom.schema import DATE, PRODUCT, TOTAL


def pair_forecasts(
    actual: DataFrame, predicted: DataFrame, y_hat: str = "y_hat"
) -> DataFrame:
    """Actual and predicted value of the same product and day."""
    return actual.join(predicted.select(PRODUCT, DATE, y_hat), [PRODUCT, DATE])


def residuals(pairs: DataFrame, y: str = TOTAL, y_hat: str = "y_hat") -> DataFrame:
    return pairs.withColumn("residual", F.col(y) - F.col(y_hat))


def forecast_metrics(pairs: DataFrame, y: str = TOTAL, y_hat: str = "y_hat") -> DataFrame:
    """MAE, MSE, RMSE and MAPE per product."""
    a, p = F.col(y).cast("double"), F.col(y_hat).cast("double")
    return pairs.groupBy(PRODUCT).agg(
        F.count(F.lit(1)).alias("n"),
        mae(a, p).alias("mae"),
        mse(a, p).alias("mse"),
        rmse(a, p).alias("rmse"),
        mape(a, p).alias("mape"),
    )


def mean_rmse(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.avg("rmse").alias("mean_rmse"))
