"""Gap-free daily series, stationarity and a seasonal baseline forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.dickey_fuller import SIGNIFICANCE, mackinnon_p, most_lags, regression_t
from demandloom.functions.elimination import cross_products, eliminate, slope_t
from demandloom.functions.stats import mae, mape, mse, rmse
from demandloom.schema import DATE, PRODUCT, TOTAL
from demandloom.session import stage

# Seasonal periods in days and forecast horizon.
PERIODS = [7, 14, 30]
HORIZON = 7
YEARS = 3


def recent_years(df: DataFrame, years: int, date: str = DATE) -> DataFrame:
    """Rows of the last ``years`` years before the latest date in the table."""
    latest = df.agg(F.max(date)).scalar()
    return df.where(F.col(date) >= F.add_months(latest, -12 * years))


def window_before_latest(df: DataFrame, oldest: int, newest: int, date: str = DATE) -> DataFrame:
    """Rows from ``oldest`` to ``newest`` days before the latest date, both included."""
    latest = df.agg(F.max(date)).scalar()
    return df.where(F.col(date).between(F.date_sub(latest, oldest), F.date_sub(latest, newest)))


def daily_spine(daily: DataFrame, fill: bool = True) -> DataFrame:
    """One row per product and calendar day from its first to its last day.

    Missing days get 0.  The calendar is added as rows of zero demand before the
    sum, so the gaps are filled by the same shuffle that adds up repeated days.
    """
    dated = daily.select(PRODUCT, F.to_date(F.col(DATE)).alias(DATE), F.col(TOTAL))
    calendar = (
        dated.groupBy(PRODUCT)
        .agg(F.min(DATE).alias("_from"), F.max(DATE).alias("_to"))
        .where(F.col("_from").isNotNull())
        .select(
            PRODUCT,
            F.explode(F.sequence("_from", "_to")).alias(DATE),
            F.lit(0 if fill else None).cast(dated.schema[TOTAL].dataType).alias(TOTAL),
        )
    )
    return (
        dated.where(F.col(DATE).isNotNull())
        .unionByName(calendar)
        .groupBy(PRODUCT, DATE)
        .agg(F.sum(TOTAL).alias(TOTAL))
    )


def recent_series(daily: DataFrame, years: int = YEARS) -> DataFrame:
    return daily_spine(recent_years(daily, years))


def forward_filled_series(daily: DataFrame) -> DataFrame:
    """Daily calendar per product where a missing day repeats the last known value."""
    upto = (
        Window.partitionBy(PRODUCT).orderBy(DATE).rowsBetween(Window.unboundedPreceding, 0)
    )
    return daily_spine(daily, fill=False).withColumn(
        TOTAL, F.last(TOTAL, ignorenulls=True).over(upto)
    )


def dickey_fuller(series: DataFrame) -> DataFrame:
    """Dickey-Fuller t statistic without lagged differences, per product."""
    by_day = Window.partitionBy(PRODUCT).orderBy(DATE)
    y = F.col(TOTAL).cast("double")
    steps = series.select(
        PRODUCT,
        F.lag(y).over(by_day).alias("level"),
        (y - F.lag(y).over(by_day)).alias("step"),
    ).where(F.col("level").isNotNull() & F.col("step").isNotNull())
    return steps.groupBy(PRODUCT).agg(
        F.count(F.lit(1)).alias("n"), regression_t(F.col("step"), F.col("level")).alias("df_statistic")
    )


def stationarity(series: DataFrame) -> DataFrame:
    """Augmented Dickey-Fuller statistic, p-value and verdict per product.

    The lag order is the one of the lowest AIC on the rows that all orders share.  All cross
    products of level and lagged differences are sums with map-side combine, one
    matrix per product; successive elimination gives the residuals of every order from it.
    Series of fewer than 8 values or of one value have no statistic.  Null values are left out.
    """
    by_day = Window.partitionBy(PRODUCT).orderBy(DATE)
    y = F.col("y")
    known = series.select(PRODUCT, DATE, F.col(TOTAL).cast("double").alias("y")).where(y.isNotNull())
    sizes = known.groupBy(PRODUCT).agg(
        F.count(F.lit(1)).cast("int").alias("n"), (F.max("y") > F.min("y")).alias("varies")
    ).withColumn("top", most_lags(F.col("n")))
    # Lengths are bounded by the calendar, and the number of lags by their fourth root.
    sizes = stage(sizes, "sizes")
    testable = (F.col("n") >= 8) & (F.col("top") >= 0) & F.col("varies")
    top = sizes.where(testable).agg(F.max("top")).first()[0] or 0
    steps = known.select(
        PRODUCT,
        (F.row_number().over(by_day) - 2).alias("at"),
        F.lag("y").over(by_day).alias("level"),
        (y - F.lag("y").over(by_day)).alias("step"),
        F.lit(1.0).alias("one"),
        DATE,
    )
    lags = [F.lag("step", k).over(by_day).alias(f"back_{k}") for k in range(1, top + 1)]
    rows = stage(steps.select("*", *lags).where("at >= 0").drop(DATE), "steps")
    variables = ["one", "level", *[f"back_{k}" for k in range(1, top + 1)], "step"]

    shared = rows.join(sizes.where(testable), PRODUCT).where(F.col("at") >= F.col("top")).groupBy(PRODUCT).agg(
        F.first("n").alias("n"), F.first("top").alias("top"), cross_products(variables).alias("m")
    )
    # Written once, or every step of the elimination would add up the matrix anew.
    shared = stage(shared, "products")
    # Constant, level, then one lag after the other.
    rest = F.slice(eliminate(F.col("m"), F.sequence(F.lit(0), F.col("top") + 1))["rest"], 2, F.col("top") + 1)
    m = F.col("n") - 1 - F.col("top")
    scored = F.transform(
        rest, lambda r, k: F.struct((m * F.log(F.greatest(r, F.lit(1e-300)) / m) + 2 * (k + 2)).alias("aic"), k.alias("lags"))
    )
    best = stage(shared.select(PRODUCT, "n", F.array_min(scored)["lags"].alias("lags")), "lags")
    final = rows.join(best, PRODUCT).where(F.col("at") >= F.col("lags")).groupBy(PRODUCT).agg(
        F.first("lags").alias("adf_lags"),
        (F.first("n") - 1 - F.first("lags")).alias("used"),
        cross_products(variables).alias("m"),
    )
    final = stage(final, "products")
    others = F.concat(
        F.array(F.lit(0)),
        F.when(F.col("adf_lags") > 0, F.sequence(F.lit(2), F.col("adf_lags") + 1)).otherwise(F.array().cast("array<int>")),
    )
    tested = final.select(
        PRODUCT, "adf_lags", "used", slope_t(F.col("m"), others, F.lit(1), F.col("used")).alias("adf_statistic")
    )
    joined = sizes.select(PRODUCT, "n").join(tested, PRODUCT, "left")
    p_value = mackinnon_p(F.col("adf_statistic"))
    return joined.select(
        PRODUCT,
        "adf_statistic",
        "adf_lags",
        F.coalesce("used", "n").alias("n_used"),
        p_value.alias("p_value"),
        F.when(p_value < SIGNIFICANCE, "Yes").otherwise("No").alias("stationary"),
    )


def _lagged(series: DataFrame, periods: list[int]) -> DataFrame:
    """Series with its position from both ends and the value one season ago, per period."""
    by_day = Window.partitionBy(PRODUCT).orderBy(DATE)
    y = F.col(TOTAL).cast("double")
    return series.select(
        PRODUCT,
        DATE,
        y.alias("y"),
        F.row_number().over(by_day).alias("from_start"),
        F.count(F.lit(1)).over(Window.partitionBy(PRODUCT)).alias("days"),
        *[F.lag(y, m).over(by_day).alias(f"back_{m}") for m in periods],
    ).withColumn("from_end", F.col("days") - F.col("from_start") + 1)


def _long_periods(lagged: DataFrame, periods: list[int]) -> DataFrame:
    choices = F.array(
        *[F.struct(F.lit(m).alias("period"), F.col(f"back_{m}").alias("y_hat")) for m in periods]
    )
    return lagged.withColumn("c", F.explode(choices)).select(
        PRODUCT, DATE, "y", "from_start", "from_end", "c.period", "c.y_hat"
    )


def seasonal_baseline(
    series: DataFrame, periods: list[int] = PERIODS, horizon: int = HORIZON
) -> DataFrame:
    """Best seasonal period per product and its error on the held-out last days.

    For each period the one-season-ago forecast is scored on the days before the
    holdout that have a value for every period; AIC = n ln(variance) + 2 (period + 1).
    """
    cases = _long_periods(_lagged(series, periods), periods)
    held = F.col("from_end") <= horizon
    train = ~held & (F.col("from_start") > max(periods))
    actual, guess = F.when(held, F.col("y")), F.when(held, F.col("y_hat"))
    scored = cases.groupBy(PRODUCT, "period").agg(
        F.count_if(train).alias("n_train"),
        F.avg(F.when(train, F.pow(F.col("y") - F.col("y_hat"), F.lit(2)))).alias("variance"),
        mae(actual, guess).alias("mae"),
        mse(actual, guess).alias("mse"),
        rmse(actual, guess).alias("rmse"),
        mape(actual, guess).alias("mape"),
    )
    aic = F.col("n_train") * F.log(F.greatest("variance", F.lit(1e-12))) + 2 * (F.col("period") + 1)
    ranked = scored.where(F.col("n_train") > 0).withColumn("aic", aic)
    fields = ["aic", "period", "n_train", "mae", "mse", "rmse", "mape"]
    return ranked.groupBy(PRODUCT).agg(F.min(F.struct(*fields)).alias("best")).select(
        PRODUCT, *[f"best.{f}" for f in fields]
    )


def seasonal_forecast(
    series: DataFrame, periods: list[int] = PERIODS, horizon: int = HORIZON
) -> DataFrame:
    """(product, Date, y_hat) for the ``horizon`` days after the series ends.

    Every forecast day repeats the value one best season earlier.
    """
    best = seasonal_baseline(series, periods, horizon).select(PRODUCT, "period")
    tail = _lagged(series, []).where(F.col("from_end") <= max(periods))
    return (
        tail.join(best, PRODUCT)
        .where(F.col("from_end").between(F.col("period") - horizon + 1, F.col("period")))
        .select(PRODUCT, F.date_add(DATE, F.col("period")).alias(DATE), F.col("y").alias("y_hat"))
    )
