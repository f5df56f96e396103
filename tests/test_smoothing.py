"""Smoothed forecasts against the recursion in plain Python."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta
from itertools import product

import pytest
from helpers import values

from demandloom.operators import smoothing
from demandloom.schema import DATE, PRODUCT, TOTAL

SCHEMA = f"`{PRODUCT}` string, `{DATE}` date, `{TOTAL}` long, best string, values string"
START = date(2024, 1, 1)


def run(y, m, a, b, g, score_from):
    level = sum(y[:m]) / m
    trend = (sum(y[m : 2 * m]) / m - level) / m
    seasons, sse = [v - level for v in y[:m]], 0.0
    for t in range(m, len(y)):
        season = seasons[t % m]
        miss = y[t] - (level + trend + season)
        old, level = level, a * (y[t] - season) + (1 - a) * (level + trend)
        trend = b * (level - old) + (1 - b) * trend
        seasons[t % m] = g * (y[t] - level) + (1 - g) * season
        sse += miss * miss if t >= score_from else 0.0
    return level, trend, seasons, sse


def choose(y, periods, horizon):
    train = y[:-horizon]
    usable = [m for m in periods if len(train) >= 2 * m]
    if not usable:
        return None
    n = len(train) - max(usable)
    points = []
    for m, a, b, g in product(usable, smoothing.LEVEL_WEIGHTS, smoothing.TREND_WEIGHTS, smoothing.SEASON_WEIGHTS):
        sse = run(train, m, a, b, g, max(usable))[3]
        points.append((round(n * math.log(max(sse / n, 1e-12)) + 2 * (m + 5), 6), m, a, b, g))
    return min(points), n


def forecast(y, m, a, b, g, horizon):
    level, trend, seasons, _ = run(y, m, a, b, g, 0)
    return [level + h * trend + seasons[(len(y) + h - 1) % m] for h in range(1, horizon + 1)]


@pytest.fixture(scope="module")
def table():
    rng = random.Random(8)
    found = {
        "weekly": [20 + 9 * (t % 7 == 5) + t // 10 + rng.randint(0, 3) for t in range(120)],
        "fortnight": [30 + 8 * (t % 14 > 8) + rng.randint(0, 2) for t in range(90)],
        "flat": [4] * 45,
        "short": [rng.randint(0, 9) for _ in range(21)],
        "too short": [1] * 20,
    }
    return found


def frame(spark, table, gap=None):
    rows = [(p, START + timedelta(days=t), None if (p, t) == gap else v, "x", "y") for p, y in table.items() for t, v in enumerate(y)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def test_choice_and_errors(spark, table):
    got = {r[PRODUCT]: r for r in smoothing.smoothed_baseline(frame(spark, table)).collect()}
    assert set(got) == set(table) - {"too short"}
    for name, row in got.items():
        (aic, *point), n = choose(table[name], [7, 14, 30], 7)
        assert [row.period, row.alpha, row.beta, row.gamma] == point
        assert row.aic == pytest.approx(aic, abs=1e-5) and row.n_scored == n
        y, y_hat = table[name][-7:], forecast(table[name][:-7], *point, 7)
        assert row.mae == pytest.approx(sum(abs(u - v) for u, v in zip(y, y_hat)) / 7)
        assert row.rmse == pytest.approx(math.sqrt(sum((u - v) ** 2 for u, v in zip(y, y_hat)) / 7))
    assert got["fortnight"].period == 14 and got["short"].period == 7


def test_forecast_follows_the_series(spark, table):
    got = values(smoothing.smoothed_forecast(frame(spark, table)))
    want = []
    for name, y in table.items():
        if choose(y, [7, 14, 30], 7):
            point = choose(y, [7, 14, 30], 7)[0][1:]
            want += [(name, START + timedelta(days=len(y) + h), v) for h, v in enumerate(forecast(y, *point, 7))]
    want.sort(key=repr)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want])


def test_nulls_count_as_no_demand_and_empty_tables(spark, table):
    one = {"weekly": list(table["weekly"])}
    empty = {"weekly": [0 if t == 50 else v for t, v in enumerate(table["weekly"])]}
    assert values(smoothing.smoothed_forecast(frame(spark, one, ("weekly", 50)))) == values(smoothing.smoothed_forecast(frame(spark, empty)))
    nothing = frame(spark, one).limit(0)
    assert smoothing.smoothed_forecast(nothing).count() == 0 and smoothing.smoothed_baseline(nothing).count() == 0
