from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import values
from pyspark.sql import Observation
from pyspark.sql import functions as F

from demandloom.functions.dates import calendar_parts, has_date_shape, week_parts
from demandloom.functions.text import file_stem, number_or_null, processed_name
from demandloom.operators import clean, dedup
from demandloom.schema import DATE, PRODUCT, QUANTITY, RAW_COLUMNS, TX_ID, TYPED


def text_row(spark, **overrides):
    base = dict.fromkeys(RAW_COLUMNS, "x")
    base |= {DATE: "2024-01-01", "Unit Price": "1.5", QUANTITY: "2.5"} | overrides
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"`{c}` string" for c in base))


def test_types_follow_the_data_model(spark):
    typed = clean.coerce_types(text_row(spark))
    assert typed.schema == TYPED
    assert typed.first()[DATE] == datetime(2024, 1, 1)
    assert typed.first()[QUANTITY] == 3
    assert clean.coerce_types(text_row(spark, Quantity="-2.5")).first()[QUANTITY] == -3


def test_types_of_absent_columns_and_empty_tables(spark):
    assert clean.coerce_types(text_row(spark).select(DATE)).columns == [DATE]
    assert clean.coerce_types(text_row(spark).limit(0)).schema == TYPED


@pytest.mark.parametrize("bad", [{"Quantity": "a dozen"}, {"Date": "someday"}])
def test_bad_values_raise(spark, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.coerce_types(text_row(spark, **bad)).collect()


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2033-11-07 21:05:59.250", datetime(2033, 11, 7, 21, 5, 59, 250000)),
        ("2033-11-07 21:05:59", datetime(2033, 11, 7, 21, 5, 59)),
        ("2033-11-07 21:05:59.987654321", datetime(2033, 11, 7, 21, 5, 59, 987654)),
        ("2033-11-07", datetime(2033, 11, 7)),
        ("11-07-2033", datetime(2033, 11, 7)),
        ("07/11/2033", datetime(2033, 11, 7)),
        ("7/8/2033", datetime(2033, 7, 8)),
        ("7-8-2033", datetime(2033, 7, 8)),
        ("2033-06-31", None),
        ("17-04-2033", None),
        ("2033-11-07\n", None),
        (" 2033-11-07", None),
        ("next week", None),
        ("21:05:59", None),
        ("20331107", None),
        ("7.5", None),
        ("", None),
        ("7/8/2033 noon", None),
        (None, None),
    ],
)
def test_date_spellings(spark, text, expected):
    df = spark.createDataFrame([(text,)], f"`{DATE}` string")
    assert clean.standardize_dates(df).first()[0] == expected


def test_date_column_absent(spark):
    df = spark.range(2)
    assert clean.standardize_dates(df) is df


def test_dates_do_not_depend_on_the_time_zone(spark):
    df = spark.createDataFrame([("2023-03-26 02:30:00",)], f"`{DATE}` string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert clean.standardize_dates(df).first()[0] == datetime(2023, 3, 26, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar(spark):
    days = [date(2020, 1, 1), date(2020, 6, 15), date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], f"`{DATE}` date")
    weeks = df.select(*week_parts(F.col(DATE)).values()).collect()
    assert [tuple(r) for r in weeks] == [(2020, 1, 1), (2020, 6, 25), (2020, 12, 53)]
    sunday = spark.createDataFrame([(date(2024, 1, 7),)], f"`{DATE}` date")
    assert tuple(sunday.select(*calendar_parts(F.col(DATE)).values()).first()) == (7, 1, 7, 7, 1, 1)
    assert clean.add_calendar_parts(spark.range(1)).columns == ["id"]


def test_strings(spark):
    df = spark.createDataFrame(
        [("Milk", "XyZ", 1), ("CoFFEE", "12LMN", 2)], "a string, b string, n int"
    )
    assert values(clean.lowercase_strings(df)) == [("coffee", "12lmn", 2), ("milk", "xyz", 1)]
    names = [("  Milk\t",), ("\n BEEF",), ("",), (None,)]
    tidy = clean.tidy_products(spark.createDataFrame(names, f"`{PRODUCT}` string"))
    assert values(tidy) == [("",), ("beef",), ("milk",), (None,)]


def test_row_filters(spark):
    rows = [(10, "milk"), (None, "bread"), (30, None), (None, None)]
    df = spark.createDataFrame(rows, f"`{QUANTITY}` long, `{PRODUCT}` string")
    assert values(clean.drop_incomplete(df)) == [(10, "milk")]


def test_known_products_and_removed_count(spark):
    df = spark.createDataFrame(
        [("milk",), ("coffee",), ("tea",), ("juice",), (None,)], f"`{PRODUCT}` string"
    )
    seen = Observation()
    kept = clean.keep_products(df, ["milk", "coffee"], observation=seen)
    assert values(kept) == [("coffee",), ("milk",)]
    assert seen.get == {"rows_seen": 5, "rows_removed": 3}
    listed = spark.createDataFrame([("milk",), ("milk",)], f"`{PRODUCT}` string")
    assert values(clean.keep_products(df, listed)) == [("milk",)]


def test_first_row_of_a_transaction_stays(spark):
    rows = [("T001", 100, 0), ("T002", 200, 1), ("T001", 150, 2), ("T003", 300, 3), ("T002", 250, 4)]
    df = spark.createDataFrame(rows, f"`{TX_ID}` string, v int, row_seq long")
    for partitions in (1, 3):
        kept = dedup.first_per_key(df.repartition(partitions), order=["row_seq"])
        assert kept.columns == df.columns
        assert values(kept, TX_ID, "v") == [("T001", 100), ("T002", 200), ("T003", 300)]
    assert values(dedup.duplicate_count(df)) == [(5, 2)]


def test_first_row_per_file_and_null_ids(spark):
    rows = [("a", "T1", 2), ("b", "T1", 1), ("a", None, 3), ("a", None, 4)]
    df = spark.createDataFrame(rows, f"source_file string, `{TX_ID}` string, row_seq long")
    kept = dedup.first_per_key(df, order=["row_seq"], per=["source_file"])
    assert values(kept) == [("a", "T1", 2), ("a", None, 3), ("b", "T1", 1)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("a/b/Some File.v2.CSV",)], "p string")
    assert df.select(file_stem(F.col("p"))).first()[0] == "Some_File.v2"
    assert df.select(processed_name(F.col("p"))).first()[0] == "processed_Some_File.v2.csv"
    texts = spark.createDataFrame([("5",), (" 7.5 ",), ("5d",), ("ten",), ("NaN",), ("1e3",)], "t string")
    got = [r[0] for r in texts.select(number_or_null(F.col("t"))).collect()]
    assert got == [5.0, 7.5, None, None, None, 1000.0]
    dates = [("2023-01-01", True), ("01/02/2023", True), ("01-02-2023", True), ("2023/01/01", False), ("ABC", False)]
    shapes = spark.createDataFrame(dates, "d string, ok boolean")
    assert shapes.where(has_date_shape(F.col("d")) != F.col("ok")).isEmpty()
