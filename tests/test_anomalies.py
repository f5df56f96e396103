from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from demandloom.operators import anomalies
from demandloom.operators.anomalies import KINDS
from demandloom.schema import DATE, PRICE, PRODUCT, QUANTITY, TX_ID

SCHEMA = (
    f"`{TX_ID}` long, `{DATE}` timestamp_ntz, `{PRODUCT}` string, `{PRICE}` double, `{QUANTITY}` long"
)

def own_rows():
    """Seeded sales of three products over two days, with values planted far outside."""
    rng = random.Random(41)
    rows = []
    for product, level, spread in (("tea", 30, 4), ("flour", 12, 3), ("dates", 70, 9)):
        for day in (11, 12):
            for _ in range(9):
                hour = rng.choice([5, 6, 9, 13, 17, 22, 23])
                rows.append([day, hour, product, round(rng.uniform(level - spread, level + spread), 2), rng.randint(3, 8)])
    for k, column, value in ((4, 3, 950.0), (13, 4, 77), (22, 4, 0), (31, 3, 0.01), (40, 4, -2)):
        rows[k][column] = value
    return [(i, datetime(2031, 5, d, h, 7 * i % 60), n, p, q) for i, (d, h, n, p, q) in enumerate(rows, 101)]


def expected_sets(rows):
    """The four screens, stated row by row."""
    groups = {}
    for r in rows:
        groups.setdefault((r[2], r[1].date()), []).append(r)
    found = {k: set() for k in KINDS}
    for group in groups.values():
        for kind, at in (("price_anomalies", 3), ("quantity_anomalies", 4)):
            if len(group) >= 4:
                found[kind] |= {r[0] for r, bad in zip(group, plain_outliers([r[at] for r in group])) if bad}
    found["time_anomalies"] = {r[0] for r in rows if not 6 <= r[1].hour <= 22}
    found["format_anomalies"] = {r[0] for r in rows if r[4] <= 0}
    return {k: sorted(v) for k, v in found.items()}


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(own_rows(), SCHEMA)


def ids(df):
    return sorted(r[0] for r in df.select(TX_ID).collect())


def test_sets_of_own_rows(sample):
    expected = expected_sets(own_rows())
    assert all(expected.values())
    flagged = anomalies.flag_anomalies(sample)
    sets = anomalies.anomaly_sets(flagged)
    assert {k: ids(v) for k, v in sets.items()} == expected
    assert sets["time_anomalies"].columns[-3:] == ["datetime", "date_only", "hour"]
    clean = anomalies.clean_rows(flagged)
    bad = set().union(*expected.values())
    assert ids(clean) == sorted(r[0] for r in own_rows() if r[0] not in bad)
    assert clean.columns == sample.columns
    assert ids(anomalies.clean_rows(flagged, unique_ids=True)) == ids(clean)
    union = anomalies.anomaly_union(flagged)
    assert values(union, TX_ID, "anomaly_type") == sorted(((i, k) for k, v in expected.items() for i in v), key=repr)


def test_own_rows_without_broadcast(no_broadcast, sample):
    bad = set().union(*expected_sets(own_rows()).values())
    assert anomalies.clean_rows(anomalies.flag_anomalies(sample)).count() == len(own_rows()) - len(bad)


def test_small_and_empty_inputs(spark, sample):
    """Three rows in a group are too few for bounds, however far apart they lie."""
    small = [(i, datetime(2031, 5, 11, 12), "tea", p, q) for i, p, q in ((1, 1.0, 1), (2, 1.0, 1), (3, 900.0, 90))]
    assert anomalies.clean_rows(anomalies.flag_anomalies(spark.createDataFrame(small, SCHEMA))).count() == 3
    empty = anomalies.flag_anomalies(sample.limit(0))
    assert all(v.isEmpty() for v in anomalies.anomaly_sets(empty).values())


def test_price_column_is_optional(sample):
    flagged = anomalies.flag_anomalies(sample.drop(PRICE))
    assert anomalies.anomaly_set(flagged, "price_anomalies").isEmpty()
    assert ids(anomalies.anomaly_set(flagged, "quantity_anomalies")) == expected_sets(own_rows())["quantity_anomalies"]


def test_given_bounds(sample):
    groups = sample.groupBy(PRODUCT, F.to_date(DATE).alias("date_only")).agg(F.count("*").alias("_price_n"))
    limits = {"price": (20.0, 60.0), "quantity": (4, 7)}
    bounds = groups.select(
        PRODUCT, "date_only", "_price_n", F.col("_price_n").alias("_quantity_n"),
        *[F.lit(x).alias(f"_{m}_{c}") for m, pair in limits.items() for x, c in zip(pair, ("lower_bound", "upper_bound"))],
    )
    flagged = anomalies.flag_anomalies(sample, bounds)
    for at, measure in ((3, "price"), (4, "quantity")):
        low, high = limits[measure]
        assert ids(anomalies.anomaly_set(flagged, f"{measure}_anomalies")) == [r[0] for r in own_rows() if not low <= r[at] <= high]


def test_one_flag_removes_every_row_with_the_id(spark):
    rows = [(1, datetime(2023, 1, 1, 3), "a", 1.0, 1), (1, datetime(2023, 1, 1, 12), "a", 1.0, 1),
            (2, datetime(2023, 1, 1, 12), "a", 1.0, 1), (None, datetime(2023, 1, 1, 12), "a", 1.0, 1)]
    flagged = anomalies.flag_anomalies(spark.createDataFrame(rows, SCHEMA))
    assert ids(anomalies.clean_rows(flagged)) == [2]


def bounds_of(spark, xs):
    df = spark.createDataFrame([("k", float(x)) for x in xs], "k string, x double")
    return tuple(anomalies.iqr_bounds(df, ["k"], "x").select("lower_bound", "upper_bound").first())


def test_iqr_bounds(spark):
    assert bounds_of(spark, [7.5] * 6) == (7.5, 7.5)
    assert bounds_of(spark, [-3]) == (-3.0, -3.0)
    # Quartiles -8 and 4: 1.5 ranges down, 2 up; without negative values the floor is 0.
    assert bounds_of(spark, [-14, -8, -2, 4, 10]) == (-26.0, 28.0)
    assert bounds_of(spark, [0, 6, 12, 18, 24]) == (0.0, 42.0)


def plain_outliers(xs):
    q1, q3 = np.percentile(xs, 25), np.percentile(xs, 75)
    low, high = (q1, q3) if q1 == q3 else (q1 - 1.5 * (q3 - q1), q3 + 2.0 * (q3 - q1))
    if q1 != q3 and min(xs) >= 0:
        low = max(0, low)
    return [x < low or x > high for x in xs]


def test_hot_group_against_numpy(spark):
    """A third of all rows in one (product, day)."""
    rng = random.Random(3)
    rows, n = [], 0
    for product, day, size in (("hot", 1, 400), *((f"p{i}", 1 + i % 5, 3 + i % 40) for i in range(40))):
        for _ in range(size):
            n += 1
            price = round(rng.lognormvariate(2, 1), 2)
            rows.append((n, datetime(2023, 1, day, 12), product, price, rng.randrange(1, 40)))
    expected = set()
    for key in {(r[2], r[1]) for r in rows}:
        group = [r for r in rows if (r[2], r[1]) == key]
        if len(group) >= 4:
            flags = plain_outliers([r[3] for r in group])
            expected |= {r[0] for r, bad in zip(group, flags) if bad}
    flagged = anomalies.flag_anomalies(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert set(ids(anomalies.anomaly_set(flagged, "price_anomalies"))) == expected
    assert expected
    kept, bad = anomalies.clean_rows(flagged), anomalies.anomaly_union(flagged).select(TX_ID).distinct()
    assert kept.count() + bad.count() == n
    assert len(KINDS) == 4


def test_zscores(spark):
    def scores(xs):
        df = spark.createDataFrame([("k", float(x)) for x in xs], "k string, x double")
        return [r.zscore for r in anomalies.zscores(df, "x", ["k"]).collect()]

    got = scores([10, 20, 30, 40, 50])
    assert sum(got) == pytest.approx(0)
    assert np.std(got, ddof=1) == pytest.approx(1)
    assert scores([4, 4, 4]) == [0, 0, 0]
    assert scores([4]) == [0]
