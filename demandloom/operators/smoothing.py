"""Seasonal forecasts by smoothed level, trend and season, weights and period chosen by AIC.

A series is one ordered array per product: one value per calendar day, so its length is bounded by
the calendar.  The recursion is a fold over that array, run for every period and every triple of
weights of the grid inside the row; products are spread over the tasks, and no row is multiplied.

Defined results: a null value counts as no demand; a period needs two whole seasons before the
holdout, and a series too short for every period has no row; all periods of a series are scored on the
same days, those after its longest usable period; of equal AIC (to six digits) the shorter
period and then the smaller weights win.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.stats import mae, mape, mse, rmse
from demandloom.operators.series import HORIZON, PERIODS
from demandloom.schema import DATE, PRODUCT, TOTAL
from demandloom.session import stage

LEVEL_WEIGHTS = [0.1, 0.3, 0.6]
TREND_WEIGHTS = [0.0, 0.1]
SEASON_WEIGHTS = [0.1, 0.3]

CHOICE = ["period", "alpha", "beta", "gamma"]


def weight_grid(periods: list[int] = PERIODS) -> Column:
    """Every period with every triple of weights, as an array of structs."""
    return F.array(
        *[
            F.struct(*[F.lit(v).alias(name) for name, v in zip(CHOICE, point)])
            for point in product(periods, LEVEL_WEIGHTS, TREND_WEIGHTS, SEASON_WEIGHTS)
        ]
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, y: s + y)


def smooth(values: Column, size: Column, point: Column, score_from: Column) -> Column:
    """State (level, trend, seasons, sse, at) after the first ``size`` values.

    The first season gives the level and the seasons, the second one the trend; squared errors of
    the one-day forecasts count from position ``score_from`` on.  The first of ``seasons``
    belongs to the next day.
    """
    m, a, b, g = (point[name] for name in CHOICE)
    first = F.slice(values, F.lit(1), m)
    mean = _total(first) / m
    later = _total(F.slice(values, m + 1, m)) / m

    def step(s: Column, y: Column) -> Column:
        season, base = s["seasons"][0], s["level"] + s["trend"]
        miss = y - (base + season)
        level = a * (y - season) + (1 - a) * base
        return F.struct(
            level.alias("level"),
            (b * (level - s["level"]) + (1 - b) * s["trend"]).alias("trend"),
            F.concat(F.slice(s["seasons"], F.lit(2), m - 1), F.array(g * (y - level) + (1 - g) * season)).alias("seasons"),
            (s["sse"] + F.when(s["at"] >= score_from, miss * miss).otherwise(0.0)).alias("sse"),
            (s["at"] + 1).alias("at"),
        )

    start = F.struct(
        mean.alias("level"),
        ((later - mean) / m).alias("trend"),
        F.transform(first, lambda y: y - mean).alias("seasons"),
        F.lit(0.0).alias("sse"),
        m.alias("at"),
    )
    return F.aggregate(F.slice(values, m + 1, size - m), start, step)


def ahead(state: Column, period: Column, days: Column) -> Column:
    """The forecast ``days`` (1, 2, ...) after the state's last value."""
    return state["level"] + days * state["trend"] + F.element_at(state["seasons"], F.pmod(days - 1, period) + 1)


def _arrays(series: DataFrame) -> DataFrame:
    """(product, last_date, values, size): one row per product, values by day."""
    y = F.coalesce(F.col(TOTAL).cast("double"), F.lit(0.0))
    days = F.array_sort(F.collect_list(F.struct(F.col(DATE).alias("day"), y.alias("y"))))
    ordered = series.groupBy(PRODUCT).agg(days.alias("days"))
    return ordered.select(
        PRODUCT,
        F.element_at("days", -1)["day"].alias("last_date"),
        F.transform("days", lambda d: d["y"]).alias("values"),
        F.size("days").alias("size"),
    )


def _chosen(arrays: DataFrame, periods: list[int], horizon: int) -> DataFrame:
    """Rows of ``arrays`` with the best point of the grid on the days before the holdout."""
    fits = lambda m: F.col("n_train") >= 2 * m
    known = arrays.withColumn("n_train", F.col("size") - horizon)
    known = known.withColumn("score_from", F.greatest(F.lit(None).cast("int"), *[F.when(fits(m), m) for m in periods]))
    known = known.where(F.col("score_from").isNotNull())
    scored = F.col("n_train") - F.col("score_from")

    def judged(w: Column) -> Column:
        sse = smooth(F.col("values"), F.col("n_train"), w, F.col("score_from"))["sse"]
        # Three weights, level, trend and one value per day of the season.
        aic = scored * F.log(F.greatest(sse / scored, F.lit(1e-12))) + 2 * (w["period"] + 5)
        return F.struct(F.round(aic, 6).alias("aic"), *[w[name].alias(name) for name in CHOICE])

    best = F.array_min(F.transform(F.filter(weight_grid(periods), lambda w: fits(w["period"])), judged))
    return known.withColumn("best", best).withColumn("n_scored", scored)


def smoothed_baseline(series: DataFrame, periods: list[int] = PERIODS, horizon: int = HORIZON) -> DataFrame:
    """Chosen period and weights per product, and the errors on the held-out last ``horizon`` days."""
    # Written, or the search would run again for the state of the best point.
    best = stage(_chosen(_arrays(series), periods, horizon), "smoothing")
    state = smooth(F.col("values"), F.col("n_train"), F.col("best"), F.col("score_from"))
    fitted = best.withColumn("state", state)
    days = fitted.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    actual = F.element_at("values", F.col("n_train") + F.col("h"))
    cases = days.select(PRODUCT, "best", "n_scored", actual.alias("y"), ahead(F.col("state"), F.col("best.period"), F.col("h")).alias("y_hat"))
    y, y_hat = F.col("y"), F.col("y_hat")
    return cases.groupBy(PRODUCT, "best", "n_scored").agg(
        mae(y, y_hat).alias("mae"), mse(y, y_hat).alias("mse"), rmse(y, y_hat).alias("rmse"), mape(y, y_hat).alias("mape")
    ).select(PRODUCT, "best.aic", *[f"best.{name}" for name in CHOICE], "n_scored", "mae", "mse", "rmse", "mape")


def smoothed_forecast(series: DataFrame, periods: list[int] = PERIODS, horizon: int = HORIZON) -> DataFrame:
    """(product, Date, y_hat) for the ``horizon`` days after the series ends.

    Period and weights are chosen before the holdout; the state then runs to the end of the series.
    """
    best = stage(_chosen(_arrays(series), periods, horizon), "smoothing")
    state = smooth(F.col("values"), F.col("size"), F.col("best"), F.col("score_from"))
    days = best.withColumn("state", state).select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    return days.select(
        PRODUCT,
        F.date_add("last_date", F.col("h")).alias(DATE),
        ahead(F.col("state"), F.col("best.period"), F.col("h")).alias("y_hat"),
    )
