from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from demandloom.operators import demand, profile
from demandloom.operators.aggregate import daily_demand, date_span, sorted_daily
from demandloom.schema import BRONZE, DATE, PRODUCT, QUANTITY, TOTAL


def price(spark, value, start, year, rates=demand.INFLATION_RATES):
    df = spark.createDataFrame([(value, start, year)], "p double, s int, y int")
    return df.select(demand.inflation_price(F.col("p"), F.col("s"), F.col("y"), rates)).first()[0]


def test_inflation(spark):
    assert price(spark, 10.0, 2020, 2020) == 10.0
    assert price(spark, 10.0, 2022, 2020) == 10.0
    assert price(spark, 10.0, 2019, 2021) == round(10 * 1.012 * 1.047, 2)
    assert price(spark, 10.0, 1999, 2000) == 10.34
    with pytest.raises(Exception, match="no inflation rate"):
        price(spark, 10.0, 2023, 2026)
    with pytest.raises(Exception, match="no inflation rate"):
        price(spark, 10.0, 2000, 2003, {2001: 1.0, 2003: 1.0})
    assert price(spark, 10.0, 2002, 2003, {2001: 1.0, 2003: 2.0}) == 10.2


def test_base_price(spark):
    df = spark.createDataFrame([(1.239, 5.0), (None, 7.501)], "o double, d double")
    assert values(df.select(demand.base_price(F.col("o"), F.col("d")))) == [(1.24,), (7.5,)]


def test_wide_and_long(spark):
    wide = spark.createDataFrame([(date(2024, 1, 1), 5, 0), (date(2024, 1, 2), -1, 3)], f"`{DATE}` date, milk long, beef long")
    long = demand.demand_to_long(wide, ["milk", "beef"])
    assert values(long) == [(date(2024, 1, 1), "milk", 5), (date(2024, 1, 2), "beef", 3)]
    back = demand.demand_to_wide(long, ["milk", "beef"])
    assert values(back) == [(date(2024, 1, 1), 5, None), (date(2024, 1, 2), None, 3)]


@pytest.mark.parametrize("rows_per_block", [2, 1000])
def test_business_hours(spark, rows_per_block):
    rows = [(date(2024, 1, 1), i) for i in range(8)] + [(date(2024, 1, 2), 99)]
    df = spark.createDataFrame(rows, "day date, seq long")
    spread = demand.spread_over_day(df, "day", "seq", rows_per_block).orderBy("seq").collect()
    opening = datetime(2024, 1, 1, 8)
    expected = [opening + timedelta(seconds=s) for s in np.linspace(0, 43200, 8)]
    assert [r.timestamp for r in spread[:8]] == expected
    assert spread[8].timestamp == datetime(2024, 1, 2, 8)


def test_influence_and_composition(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], f"`{PRODUCT}` string, p double")
    assert values(demand.price_influence(df, "p"), "influence") == [(0.25,), (0.5,), (0.75,)]
    factors = spark.createDataFrame([(10.0, 0.5, 1.1, 2.0, 0.2), (1.0, 0.0, 1.0, 1.0, -9.0), (2.5, 0.0, 1.0, 1.0, 0.0)], "b double, i double, w double, s double, n double")
    composed = factors.select(demand.compose_demand(*[F.col(c) for c in "biwsn"]).alias("d"))
    assert [r.d for r in composed.collect()] == [33, 0, 2]
    days = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 1, 6),)], "d date")
    shock = days.select(demand.weekend_shock(F.col("d"), F.lit(1.5)), demand.weekday_slot(F.col("d"), F.lit("2024-01-01").cast("date")))
    assert values(shock) == [(1.0, 4), (1.5, 5)]


def test_daily_sum_keeps_the_total(spark):
    rows = [("2023-01-01", "milk", 10), ("2023-01-01", "milk", 5), ("2023-01-01", "milk", 3),
            ("2023-01-01", "coffee", 8), ("2023-01-02", "milk", 7), ("2023-01-02", "coffee", 6)]
    df = spark.createDataFrame([(datetime.fromisoformat(d), p, q) for d, p, q in rows], f"`{DATE}` timestamp_ntz, `{PRODUCT}` string, `{QUANTITY}` long")
    found = sorted_daily(daily_demand(df)).collect()
    assert [(str(r[0]), r[1], r[2]) for r in found] == [
        ("2023-01-01", "coffee", 8), ("2023-01-01", "milk", 18), ("2023-01-02", "coffee", 6), ("2023-01-02", "milk", 7)]
    assert daily_demand(df.limit(0)).columns == [DATE, PRODUCT, TOTAL]
    assert values(date_span(daily_demand(df), [PRODUCT]))[0] == ("coffee", date(2023, 1, 1), date(2023, 1, 2))


def test_quality_profile(spark):
    good = ("2024-01-01 10:00:00", "1.5", "2", "T1", "Downtown", "milk", "1")
    rows = [
        good,
        good,
        (None, "0", "3", "T2", "1234", "m@ilk", None),
        ("01-02-2024", None, "-4", "T3", None, " MILK ", "2"),
        ("01/02/2024", "2", "0", "T4", "Uptown", None, "2"),
    ]
    found = {r.defect: r.defect_rows for r in profile.quality_profile(spark.createDataFrame(rows, BRONZE)).collect()}
    assert found == {
        "null_date": 1, "null_price": 1, "null_quantity": 0, "null_producer": 1, "null_store": 1, "null_product": 1,
        "non_iso_date": 2, "negative_quantity": 1, "zero_quantity": 1, "numeric_store": 1, "unknown_product": 1,
        "free_item": 1, "duplicate_id": 1,
    }
