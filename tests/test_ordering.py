from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from helpers import values

from demandloom.operators.ordering import date_order, fill_missing_dates, neighbour_dates
from demandloom.schema import DATE

SCHEMA = f"source_file string, row_seq long, `{DATE}` timestamp_ntz"


def series(spark, dates, source="f"):
    stamps = [datetime.fromisoformat(d) if isinstance(d, str) else d for d in dates]
    return spark.createDataFrame([(source, i, d) for i, d in enumerate(stamps)], SCHEMA)


def plain_order(dates):
    """Direction of the days that are known; fewer than two have none."""
    days = [d.date() for d in dates if d is not None]
    pairs = list(zip(days, days[1:]))
    if pairs and all(x <= y for x, y in pairs):
        return "Ascending"
    return "Descending" if pairs and all(x >= y for x, y in pairs) else "Random"


@pytest.mark.parametrize("rows_per_block", [1, 2, 100])
def test_date_order_against_plain_python(spark, rows_per_block):
    """Short own series: every direction, gaps, one date, and hours that run against the days."""
    rng = random.Random(17)
    files, first = {}, datetime(2033, 9, 14, 12)
    for k in range(30):
        direction = (1, -1, 0)[k % 3]
        dates, now = [], first
        for _ in range(1 + k % 6):
            now += timedelta(days=(direction or rng.choice([-1, 1])) * rng.randint(0, 40))
            dates.append(None if rng.random() < 0.25 else now - timedelta(hours=rng.randint(0, 11)))
        files[f"s{k}"] = dates
    rows = [(f, i, d) for f, dates in files.items() for i, d in enumerate(dates)]
    found = values(date_order(spark.createDataFrame(rows, SCHEMA), rows_per_block=rows_per_block))
    assert found == sorted(((f, plain_order(dates)) for f, dates in files.items()), key=repr)
    assert {x for _, x in found} == {"Ascending", "Descending", "Random"}


def test_date_order_of_nothing(spark):
    assert date_order(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert values(date_order(series(spark, [None, None]))) == [("f", "Random")]


def plain_fill(dates):
    """Row-by-row statement of the rule for one file."""
    known = [(i, d) for i, d in enumerate(dates) if d is not None]
    days = [d.date() for _, d in known]
    pairs = list(zip(days, days[1:]))
    ordered = len(days) >= 2 and (all(a <= b for a, b in pairs) or all(a >= b for a, b in pairs))
    out = []
    for i, d in enumerate(dates):
        if d is not None:
            out.append((i, d))
            continue
        before = [k for k in known if k[0] < i]
        after = [k for k in known if k[0] > i]
        if not before or not after or not ordered:
            continue
        (pi, p), (ni, n) = before[-1], after[0]
        if p.date() == n.date():
            span = (n - p) // timedelta(microseconds=1) * (i - pi)
            share = span // (ni - pi) if span >= 0 else -(-span // (ni - pi))
            out.append((i, p + timedelta(microseconds=share)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_missing_dates_against_plain_python(spark, seed):
    """Several files of all three orders, runs of missing dates longer than a block."""
    rng = random.Random(seed)
    rows, expected = [], []
    for source, direction in (("up", 1), ("down", -1), ("mixed", 0)):
        now, dates = datetime(2024, 1, 15), []
        for _ in range(120):
            step = timedelta(minutes=rng.randrange(0, 200))
            now += step * (direction or rng.choice([1, -1]))
            dates.append(now)
        for _ in range(12):
            start = rng.randrange(120)
            for i in range(start, min(120, start + rng.randrange(1, 15))):
                dates[i] = None
        rows += [(source, i, d) for i, d in enumerate(dates)]
        expected += [(source, i, d) for i, d in plain_fill(dates)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for rows_per_block, partitions in ((7, 3), (50, 1), (1000, 4)):
        filled = fill_missing_dates(df.repartition(partitions), rows_per_block=rows_per_block)
        assert values(filled) == sorted(expected, key=repr)


def test_given_blocks_are_used(spark):
    """Order by (block, seq) when the sequence restarts or jumps between blocks."""
    rows = [("f", 500, 7, "2022-01-01 12:00"), ("f", 0, 90, "2022-01-01 10:00"), ("f", 0, 95, None)]
    df = spark.createDataFrame(
        [(s, b, q, d and datetime.fromisoformat(d)) for s, b, q, d in rows],
        f"source_file string, row_block long, row_seq long, `{DATE}` timestamp_ntz",
    )
    filled = fill_missing_dates(df, block="row_block")
    assert (95, datetime(2022, 1, 1, 11)) in values(filled, "row_seq", DATE)


def test_negative_sequence_and_gaps(spark):
    near = neighbour_dates(
        spark.createDataFrame(
            [("f", -7, datetime(2022, 1, 1)), ("f", -3, None), ("f", 250_000, datetime(2022, 1, 2))], SCHEMA
        )
    )
    row = near.where("row_seq = -3").first()
    assert (row.prev_gap, row.next_gap) == (1, 1)
    assert (row.prev_valid, row.next_valid) == (datetime(2022, 1, 1), datetime(2022, 1, 2))
