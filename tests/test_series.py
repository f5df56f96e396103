from __future__ import annotations

import itertools
import math
from datetime import date, timedelta

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from demandloom.functions import dickey_fuller
from demandloom.functions.ks import asymptotic_p, exact_p
from demandloom.operators import drift, evaluate, features, series
from demandloom.plans import monitoring
from demandloom.schema import DATE, PRODUCT, TOTAL

DAILY = f"`{PRODUCT}` string, `{DATE}` date, `{TOTAL}` long"
START = date(2024, 1, 1)


def daily(spark, quantities, product="A", start=START):
    rows = [(product, start + timedelta(days=i), q) for i, q in enumerate(quantities)]
    return spark.createDataFrame(rows, DAILY)


def test_lags_and_rolling_mean(spark):
    found = features.time_series_features(daily(spark, range(10))).orderBy(DATE).collect()
    assert [r.lag_1 for r in found] == [None, *range(9)]
    assert [r.lag_7 for r in found] == [None] * 7 + [0, 1, 2]
    assert [r.rolling_mean_7 for r in found] == [None] * 6 + [3, 4, 5, 6]


def test_features_of_special_tables(spark):
    empty = features.time_series_features(spark.createDataFrame([], DAILY))
    assert empty.isEmpty() and {"lag_1", "is_weekend", "week_of_year"} <= set(empty.columns)
    assert features.time_series_features(spark.range(1)).columns == ["id"]
    with pytest.raises(KeyError):
        features.time_series_features(daily(spark, [1]).drop(TOTAL))
    gaps = features.lag_features(daily(spark, [1, 2, 3, None, 5, 6, 7, 8])).orderBy(DATE).collect()
    assert all(r.rolling_mean_7 is None for r in gaps)


def test_error_measures(spark):
    pairs = daily(spark, [10, 0, 4]).withColumn("y_hat", F.lit(2.0))
    row = evaluate.forecast_metrics(pairs).first()
    assert row.mae == pytest.approx((8 + 2 + 2) / 3)
    assert row.rmse == pytest.approx(math.sqrt((64 + 4 + 4) / 3))
    assert row.mape == pytest.approx(100 * (0.8 + 0.5) / 2)
    assert evaluate.mean_rmse(evaluate.forecast_metrics(pairs)).first()[0] == pytest.approx(row.rmse)


def merged_gap(order, n1, n2):
    """Largest |i*n2 - j*n1| along one merge of two samples without ties."""
    i = j = best = 0
    for first in order:
        i, j = i + first, j + (not first)
        best = max(best, abs(i * n2 - j * n1))
    return best


def test_exact_p_of_large_samples():
    for n, d in ((20_000, 0.01), (20_000, 0.03), (100_000, 0.009)):
        assert exact_p(n, n, int(d * n * n)) == pytest.approx(asymptotic_p(n, n, d), rel=0.06)
    assert exact_p(20_000, 20_000, 20_000**2 // 2) < 1e-290


def test_exact_p_at_the_ends():
    assert exact_p(3, 5, 16) == 0.0
    assert exact_p(1, 1, 1) == 1.0
    # Only the two orders that keep the samples apart reach the whole distance.
    assert exact_p(40, 60, 2400) == pytest.approx(2 / math.comb(100, 40), rel=1e-9)
    assert exact_p(300, 500, 150_000) == pytest.approx(2 / math.comb(800, 300), rel=1e-9)


@pytest.mark.parametrize(("n1", "n2"), [(2, 2), (3, 5), (4, 4), (6, 3)])
def test_exact_p_counts_all_merges(n1, n2):
    total = n1 + n2
    gaps = []
    for chosen in itertools.combinations(range(total), n1):
        gaps.append(merged_gap([k in chosen for k in range(total)], n1, n2))
    for gap in sorted(set(gaps)):
        expected = sum(g >= gap for g in gaps) / len(gaps)
        assert exact_p(n1, n2, gap) == pytest.approx(expected, rel=1e-12)


def test_known_p_values():
    assert exact_p(7, 7, 35) == pytest.approx(0.0530, abs=1e-4)
    assert exact_p(7, 7, 42) == pytest.approx(0.0082, abs=1e-4)
    assert exact_p(7, 7, 0) == 1.0
    for n, d in ((400, 0.08), (900, 0.06)):
        gap = round(d * n * n)
        assert asymptotic_p(n, n, d) == pytest.approx(exact_p(n, n, gap), rel=0.1)


def plain_gap(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) * len(b) - sum(x <= p for x in b) * len(a)) for p in points)


def test_ks_statistic_against_plain_python(spark):
    rng = np.random.default_rng(11)
    samples = {
        "hot": (np.round(rng.normal(0, 3, 700), 1), np.round(rng.normal(1, 3, 500), 1)),
        "flat": (np.full(5, 2.0), np.full(4, 2.0)),
        "apart": (np.array([1.0, 2.0]), np.array([-5.0, -6.0, -7.0])),
    }
    schema = f"`{PRODUCT}` string, x double"

    def side(i):
        return spark.createDataFrame(
            [(k, float(v)) for k, s in samples.items() for v in s[i]] + [("hot", None), ("hot", math.nan)], schema
        ).repartition(5)

    found = {r[PRODUCT]: r for r in drift.ks_statistics(side(0), side(1), [PRODUCT], ["x"]).collect()}
    for k, (a, b) in samples.items():
        assert int(found[k].gap) == plain_gap(list(a), list(b))
        assert (found[k].n_ref, found[k].n_new) == (len(a), len(b))
    verdict = drift.data_drift(side(0), side(1)).collect()
    assert {r[PRODUCT]: (r.data_drift, r.drift_columns) for r in verdict} == {
        "hot": (True, ["x"]), "flat": (False, []), "apart": (False, [])
    }


def test_too_small_samples_are_skipped(spark):
    one = spark.createDataFrame([("p", 1.0)], f"`{PRODUCT}` string, x double")
    assert drift.data_drift(one, one).isEmpty()
    assert drift.data_drift(one.union(one), one.union(one).withColumnRenamed("x", "y")).isEmpty()


def test_windows_before_the_latest_day(spark):
    table = daily(spark, range(20))
    assert [r[0] for r in values(monitoring.new_window(table), TOTAL)] == sorted(range(6, 13), key=str)
    assert len(values(monitoring.reference_window(table))) == 7


def test_report_and_decision(spark):
    level = [100] * 13 + [500] * 7
    table = daily(spark, level).unionByName(daily(spark, [50] * 20, "B"))
    y_hat = table.select(PRODUCT, DATE, F.lit(100.0).alias("y_hat"))
    report = {r[PRODUCT]: r for r in monitoring.product_report(table, y_hat).collect()}
    assert (report["A"].rmse, report["A"].data_drift, report["A"].concept_drift) == (0, True, True)
    assert (report["B"].rmse, report["B"].mape, report["B"].data_drift) == (50, 100, False)
    decision = monitoring.retrain_decision(monitoring.product_report(table, y_hat)).first()
    assert decision.asDict() == {
        "mean_rmse": 25, "rmse_exceeded": True, "data_drift": True, "concept_drift": True, "retrain": True
    }
    calm = table.where(f"`{PRODUCT}` = 'B'")
    exact = calm.select(PRODUCT, DATE, F.col(TOTAL).cast("double").alias("y_hat"))
    assert not monitoring.retrain_decision(monitoring.product_report(calm, exact)).first().retrain


def test_product_without_reference_rows(spark):
    table = daily(spark, range(20)).unionByName(daily(spark, [5] * 13, "old"))
    y_hat = table.select(PRODUCT, DATE, F.lit(5.0).alias("y_hat"))
    row = monitoring.product_report(table, y_hat).where(f"`{PRODUCT}` = 'old'").first()
    assert (row.rmse, row.data_drift, row.concept_drift, row.drift_columns) == (0, False, False, [])


def test_spine_and_fills(spark):
    rows = [("A", START, 1), ("A", START, 2), ("A", START + timedelta(days=3), 4), ("B", START, 9)]
    table = spark.createDataFrame(rows, DAILY)
    assert values(series.daily_spine(table), PRODUCT, TOTAL) == [("A", 0), ("A", 0), ("A", 3), ("A", 4), ("B", 9)]
    filled = series.forward_filled_series(table).where(f"`{PRODUCT}` = 'A'").orderBy(DATE)
    assert [r[TOTAL] for r in filled.collect()] == [3, 3, 3, 4]


def test_recent_years_clamps_leap_days(spark):
    rows = [("A", date(2021, 2, 28), 1), ("A", date(2021, 2, 27), 1), ("A", date(2024, 2, 29), 1)]
    kept = series.recent_years(spark.createDataFrame(rows, DAILY), 3)
    assert values(kept, DATE) == [(date(2021, 2, 28),), (date(2024, 2, 29),)]


def test_stationarity(spark):
    rng = np.random.default_rng(2)
    noise = (100 + rng.normal(0, 10, 200)).astype(int).tolist()
    walk = np.cumsum(rng.normal(0, 10, 200)).astype(int).tolist()
    table = daily(spark, noise, "noise").unionByName(daily(spark, walk, "walk")).unionByName(daily(spark, [3] * 50, "flat"))
    found = {r[PRODUCT]: r for r in series.stationarity(table).collect()}
    assert found["noise"].stationary == "Yes" and found["noise"].p_value < 0.01
    assert found["walk"].stationary == "No"
    assert found["flat"].adf_statistic is None and found["flat"].stationary == "No"
    plain = {r[PRODUCT]: r.df_statistic for r in series.dickey_fuller(table).collect()}
    assert plain["noise"] < -8 and plain["flat"] is None


def plain_augmented(y):
    """Statistic, lags and rows by least squares for every order, one regression at a time."""
    y = np.asarray(y, float)
    n, dy = len(y), np.diff(y)
    top = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    if n < 8 or top < 0 or np.ptp(y) == 0:
        return None, None, n

    def fit(lags, skip):
        at = np.arange(skip, n - 1)
        x = np.column_stack([np.ones(len(at)), y[at], *[dy[at - k] for k in range(1, lags + 1)]])
        beta, *_ = np.linalg.lstsq(x, dy[at], rcond=None)
        error = dy[at] - x @ beta
        rss = float(error @ error)
        spread = math.sqrt(rss / (len(at) - x.shape[1]) * np.linalg.pinv(x.T @ x)[1, 1]) if len(at) > x.shape[1] else 0.0
        return rss, len(at), float(beta[1] / spread) if spread else None

    scores = []
    for lags in range(top + 1):
        rss, rows, _ = fit(lags, top)
        scores.append(rows * math.log(max(rss, 1e-300) / rows) + 2 * (lags + 2))
    best = int(np.argmin(scores))
    return fit(best, best)[2], best, n - 1 - best


def test_augmented_against_least_squares(spark):
    rng, made = np.random.default_rng(6), {}
    for k, n in enumerate([8, 9, 12, 30, 31, 90, 250, 700]):
        made[f"noise{k}"] = (100 + rng.normal(0, 10, n)).astype(int).tolist()
        made[f"walk{k}"] = (500 + np.cumsum(rng.normal(0, 9, n))).astype(int).tolist()
        made[f"week{k}"] = [10 * (i % 7) + int(rng.integers(0, 4)) for i in range(n)]
    made["flat"], made["short"] = [3] * 40, [1, 2, 3]
    table = None
    for name, y in made.items():
        part = daily(spark, y, name)
        table = part if table is None else table.unionByName(part)
    found = {r[PRODUCT]: r for r in series.stationarity(table).collect()}
    assert set(found) == set(made)
    for name, y in made.items():
        statistic, lags, used = plain_augmented(y)
        row = found[name]
        assert (row.adf_lags, row.n_used) == (lags, used), name
        assert row.adf_statistic == (statistic if statistic is None else pytest.approx(statistic, rel=1e-6)), name


def test_augmented_of_special_series(spark):
    """Null values, an exact straight line, and a table without any series long enough."""
    noise = np.random.default_rng(8).integers(0, 50, 40).tolist()
    gaps = daily(spark, [None, 5, None, *noise], "gaps")
    line = daily(spark, list(range(50)), "line")
    found = {r[PRODUCT]: r for r in series.stationarity(gaps.unionByName(line)).collect()}
    assert found["gaps"].adf_statistic == pytest.approx(plain_augmented([5, *noise])[0], rel=1e-6)
    assert found["line"].adf_statistic is None and found["line"].stationary == "No"
    assert [r.n_used for r in series.stationarity(daily(spark, [1, 2])).collect()] == [2]
    assert series.stationarity(daily(spark, [])).collect() == []


def test_p_values(spark):
    """The normal distribution function to many digits, and the ends of the surface."""
    frame = spark.createDataFrame([(x / 7,) for x in range(-60, 61)], "x double")
    for r in frame.select("x", dickey_fuller.normal_cdf(F.col("x")).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(-r.x / math.sqrt(2)) / 2, rel=1e-9)
    taus = spark.createDataFrame([(-30.0,), (-3.43,), (-2.86,), (5.0,), (None,)], "t double")
    got = [r.p for r in taus.select(dickey_fuller.mackinnon_p(F.col("t")).alias("p")).collect()]
    assert got == [0.0, pytest.approx(0.01, abs=0.001), pytest.approx(0.05, abs=0.002), 1.0, None]


def test_seasonal_choice_and_forecast(spark):
    fortnight = [10, 12, 14, 16, 18, 20, 22, 40, 42, 44, 46, 48, 50, 52]
    table = daily(spark, fortnight * 6)
    best = series.seasonal_baseline(table).first()
    assert (best.period, best.mae, best.mape) == (14, 0, 0)
    forecast = series.seasonal_forecast(table).orderBy(DATE).collect()
    assert [r.y_hat for r in forecast] == fortnight[:7]
    assert forecast[0][DATE] == START + timedelta(days=84)
