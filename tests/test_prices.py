from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest
from helpers import values

from demandloom.operators import prices
from demandloom.schema import DATE, PRICE, PRODUCT

LEVELS = "Year int, Month int, Week_of_year int, `Product Name` string, `Unit Price` double"


def own_prices(seed):
    """Seeded (year, month, week, product, price) rows with few distinct prices."""
    rng = random.Random(seed)
    return [(2030 + rng.randint(0, 1), m := rng.randint(1, 3), 4 * m + rng.randint(0, 1), rng.choice(["rice", "oats"]), rng.choice([3.25, 4.0, 4.75, None])) for _ in range(150)]


def plain_modes(rows, width):
    """Most frequent known price per (first ``width`` fields, product), the smaller on a tie."""
    counts = {}
    for *when, name, price in rows:
        if price is not None:
            counts.setdefault((*when[:width], name), Counter())[price] += 1
    return sorted(((*k, min(c, key=lambda p: (-c[p], p))) for k, c in counts.items()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_modes_against_plain_python(spark, seed):
    rows = own_prices(seed)
    df = spark.createDataFrame(rows, LEVELS)
    for width, level in ((3, prices.WEEK), (2, prices.MONTH), (1, prices.YEAR)):
        assert values(prices.frequent_price(df, level)) == plain_modes(rows, width)


def test_mode_of_nulls_and_ties(spark):
    nothing = spark.createDataFrame([(2020, 1, 1, "Milk", None)], LEVELS)
    assert prices.frequent_price(nothing, prices.YEAR).isEmpty()
    tie = spark.createDataFrame([(2020, 1, 1, "Milk", 3.0), (2020, 1, 1, "Milk", 2.0)], LEVELS)
    assert values(prices.frequent_price(tie, prices.YEAR)) == [(2020, "Milk", 2.0)]


def test_ladder_from_given_lookups(spark):
    def lookup(rows, keys):
        columns = ", ".join(f"{k} int" for k in keys)
        return spark.createDataFrame(
            rows, f"{columns}, `Product Name` string, Most_Frequent_Cost double"
        )

    def run(rows, week=(), month=(), year=()):
        df = spark.createDataFrame(rows, LEVELS)
        return values(
            prices.apply_price_ladder(
                df,
                lookup(list(week), prices.WEEK),
                lookup(list(month), prices.MONTH),
                lookup(list(year), prices.YEAR),
            ),
            PRODUCT,
            PRICE,
        )

    # Each level answers only where the finer ones have nothing; known prices stay.
    rows = [(2031, 7, 27, "oats", 0.5), *((2031, 7, 27, n, None) for n in ("kale", "leek", "peas", "rice"))]
    week, month, year = [(2031, 7, 27, "kale", 1.1)], [(2031, 7, n, 2.2) for n in ("kale", "leek")], [(2031, n, 3.3) for n in ("kale", "leek", "peas")]
    assert run(rows, week, month, year) == [("kale", 1.1), ("leek", 2.2), ("oats", 0.5), ("peas", 3.3), ("rice", 0.0)]
    assert run(rows) == [("kale", 0.0), ("leek", 0.0), ("oats", 0.5), ("peas", 0.0), ("rice", 0.0)]


def fill_case(spark):
    rows = [
        ("2023-01-02", "milk", 4.0), ("2023-01-03", "milk", None), ("2023-01-20", "milk", None),
        ("2023-06-01", "milk", None), ("2023-06-01", "beef", None), ("2024-01-01", "milk", 9.0),
    ]
    return spark.createDataFrame(
        [(datetime.fromisoformat(d), n, p) for d, n, p in rows],
        f"`{DATE}` timestamp_ntz, `{PRODUCT}` string, `{PRICE}` double",
    )


def test_ladder_levels(spark):
    filled = prices.fill_missing_prices(fill_case(spark))
    assert filled.columns == [DATE, PRODUCT, PRICE]
    got = {(r[0].month, r[0].day, r[1]): r[2] for r in filled.collect()}
    assert got == {
        (1, 2, "milk"): 4.0, (1, 3, "milk"): 4.0, (1, 20, "milk"): 4.0,
        (6, 1, "milk"): 4.0, (6, 1, "beef"): 0.0, (1, 1, "milk"): 9.0,
    }


def test_ladder_without_broadcast(no_broadcast):
    assert prices.fill_missing_prices(fill_case(no_broadcast)).where(f"`{PRICE}` = 4").count() == 4
