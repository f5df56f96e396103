"""Totals kept by deliveries against adding up what every file gave last."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from helpers import values

from demandloom.schema import DATE, PRODUCT, SOURCE_FILE, TOTAL
from demandloom.sources import totals

SCHEMA = f"`{SOURCE_FILE}` string, `{DATE}` date, `{PRODUCT}` string, `{TOTAL}` long, other string"


def rows_of(rng, name):
    days = [None, *(date(2024, 1, 20) + timedelta(days=9 * k) for k in range(5))]
    return [(name, rng.choice(days), rng.choice("ab"), rng.choice([-3, 0, 2, 5, None]), "x") for _ in range(rng.randint(0, 4))]


def plain(state):
    sums = defaultdict(int)
    for rows in state.values():
        for _, day, product, quantity, _ in rows:
            sums[day, product] += quantity or 0
    return sorted(((d, p, q) for (d, p), q in sums.items()), key=repr)


def deliver(spark, path, number, given):
    daily = spark.createDataFrame([r for rows in given.values() for r in rows], SCHEMA)
    totals.deliver(daily, spark.createDataFrame([(n,) for n in given], "file_path string"), path, number)


def test_deliveries_add_up(spark, tmp_path):
    rng, path, state = random.Random(5), str(tmp_path / "t"), {}
    assert totals.daily_totals(spark, path).isEmpty()
    for number in range(1, 6):
        given = {name: rows_of(rng, name) for name in rng.sample(["p/f", "q/f", "g", "h"], rng.randint(1, 3))}
        deliver(spark, path, number, given)
        state |= given
        assert values(totals.daily_totals(spark, path)) == plain(state)


@pytest.mark.parametrize("cut", [0, 1])
def test_a_delivery_that_was_cut_off_is_run_again(spark, tmp_path, monkeypatch, cut):
    path, day = str(tmp_path / "t"), date(2024, 1, 31)
    old = {"f": [("f", day, "a", 4, ""), ("f", day + timedelta(days=1), "a", 6, "")], "g": [("g", day, "a", 1, "")]}
    new = {"f": [("f", day, "a", 7, ""), ("f", day + timedelta(days=40), "b", 2, "")]}
    deliver(spark, path, 1, old)
    real, calls = totals._replace, []

    def failing(df, target, key, touched):
        calls.append(target)
        if len(calls) == cut + 1:
            # The first month is written, the rest is lost; or all of the totals, and no part.
            if cut == 0:
                real(df.where(f"{key} = '2024-01'"), target, key, touched.where(f"{key} = '2024-01'"))
            raise RuntimeError("lost")
        real(df, target, key, touched)

    monkeypatch.setattr(totals, "_replace", failing)
    with pytest.raises(RuntimeError):
        deliver(spark, path, 2, new)
    monkeypatch.setattr(totals, "_replace", real)
    for _ in range(2):
        deliver(spark, path, 2, new)
        assert values(totals.daily_totals(spark, path)) == plain(old | new)
