from __future__ import annotations

import json

import pytest
from helpers import values

from demandloom.operators import profile, validate
from demandloom.schema import DAILY_COLUMNS, DATE, PRICE, PRODUCT, RAW_COLUMNS, TOTAL
from demandloom.sources.listing import list_files
from demandloom.sources.readers import read_lines
from demandloom.sources.writers import write_failures, write_stats

TEXT = ", ".join(f"`{c}` string" for c in DAILY_COLUMNS)


def raw(spark, columns=RAW_COLUMNS, rows=1):
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([("x",) * len(columns)] * rows, schema)


def test_required_columns(spark):
    assert validate.check_columns(raw(spark)) == (True, None)
    assert validate.check_columns(raw(spark, [*reversed(RAW_COLUMNS), "Extra"])) == (True, None)
    partial = [c for c in RAW_COLUMNS if c not in ("Unit Price", "Producer ID")]
    assert validate.check_columns(raw(spark, partial)) == (False, "Missing columns: Unit Price, Producer ID")
    assert validate.check_columns(raw(spark).limit(0)) == (False, "DataFrame is empty, no rows found")


def test_every_row_is_marked(spark):
    marked = validate.mark_missing(spark.range(3), ["col1", "col2"])
    assert {tuple(r.reasons) for r in marked.collect()} == {("Missing columns: col1, col2",)}
    assert validate.mark_missing(spark.range(0), ["col1"]).isEmpty()
    assert validate.mark_missing(spark.range(1), []).first().reasons == []


# The messages.
NAME, NUMBER, SIGN, NO_DATE, SHAPE = (
    "Product Name must be a string",
    "Total Quantity must be numeric",
    "Total Quantity must be greater than 0",
    "Date cannot be null",
    "Date must be in a valid date format",
)


@pytest.mark.parametrize(("product", "name"), [("kale", []), (None, [NAME])])
@pytest.mark.parametrize(("quantity", "number"), [("3.5", []), ("4e2", []), ("many", [NUMBER]), (None, [NUMBER]), ("-0.25", [SIGN]), ("0.0", [SIGN])])
@pytest.mark.parametrize(("date", "day"), [("2031-07-09", []), ("09/07/2031", []), ("2031.07.09", [SHAPE]), ("july", [SHAPE]), (None, [NO_DATE])])
def test_row_rules(spark, product, name, quantity, number, date, day):
    reasons = name + number + day
    df = spark.createDataFrame([(product, quantity, date)], TEXT)
    assert validate.check_rows(df).first().reasons == reasons
    failing = values(validate.failing_rows(df), "anomaly_reason")
    assert failing == ([("; ".join(reasons),)] if reasons else [])
    summary = validate.validation_summary(df).first()
    assert (summary.has_errors, summary.error_count) == (bool(reasons), int(bool(reasons)))


def test_product_of_another_type(spark):
    df = spark.createDataFrame([(8, "2", "2031-07-09")], TEXT.replace("string", "long", 1))
    assert validate.check_rows(df).first().reasons == [NAME]


def test_summary_of_empty_and_partial_tables(spark):
    empty = validate.validation_summary(spark.createDataFrame([], TEXT)).first()
    assert empty.asDict() == {
        "results": ["DataFrame is empty, no rows found"],
        "has_errors": False,
        "missing_columns": [],
        "error_count": 0,
    }
    partial = validate.validation_summary(spark.createDataFrame([("a",), ("b",)], f"`{PRODUCT}` string")).first()
    assert (partial.has_errors, partial.missing_columns, partial.error_count) == (True, [TOTAL, DATE], 2)


def test_files_and_batch_status(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    row = ",".join("x" * len(RAW_COLUMNS))
    contents = {
        "good.csv": f"{header}\n{row}\n{row}\n",
        "other order.csv": f'{",".join(reversed(RAW_COLUMNS))},Extra\n{row},y\n',
        "quoted+plus.csv": ",".join(f'"{c}"' for c in RAW_COLUMNS) + f"\n{row}\n",
        "header_only.csv": f"{header}\n",
        "partial.csv": f"Date,Quantity\n{row}\n",
        "zero.csv": "",
    }
    for name, text in contents.items():
        (tmp_path / name).write_text(text)
    verdicts = validate.file_verdicts(read_lines(spark, str(tmp_path)), list_files(spark, str(tmp_path)))
    found = {r.file_path.rsplit("/", 1)[-1]: (r.rows, r.valid, r.error) for r in verdicts.collect()}
    assert found["good.csv"] == (2, True, None)
    assert found["other order.csv"] == (1, True, None)
    assert found["quoted+plus.csv"] == (1, True, None)
    assert found["header_only.csv"] == (0, False, "DataFrame is empty, no rows found")
    assert found["zero.csv"] == (0, False, "DataFrame is empty, no rows found")
    assert found["partial.csv"][2] == (
        "Missing columns: Unit Price, Transaction ID, Store Location, Product Name, Producer ID"
    )
    assert values(validate.batch_status(verdicts)) == [(6, 3, 1)]
    assert values(validate.batch_status(verdicts.where("valid")))[0][2] == 0
    assert values(validate.batch_status(verdicts.where("not valid")))[0][2] == 2
    assert values(validate.batch_status(verdicts.limit(0)))[0][2] == 2
    report = validate.batch_report(verdicts).orderBy("section", "file_path").collect()
    assert [r.section for r in report] == [1, 1, 1, 2, 2, 2]
    assert report[0].line.endswith("header_only.csv: DataFrame is empty, no rows found")


def stats_input(spark):
    rows = [("Apple", 10, 1.0), ("Apple", 20, 1.2), ("Banana", 5, 0.8), ("Banana", 15, 0.9)]
    return spark.createDataFrame(rows, f"`{PRODUCT}` string, `{TOTAL}` long, `{PRICE}` double")


def test_statistics(spark):
    df = stats_input(spark)
    stats = profile.numeric_stats(df)
    assert values(stats, PRODUCT, "column") == [
        ("Apple", TOTAL), ("Apple", PRICE), ("Banana", TOTAL), ("Banana", PRICE)]
    apple = stats.where(f"`{PRODUCT}` = 'Apple' and column = '{TOTAL}'").first()
    assert (apple["mean"], apple["min"], apple["max"], apple["median"]) == (15, 10, 20, 15)
    assert apple["std"] == pytest.approx(7.0710678)
    assert (apple["25th_percentile"], apple["75th_percentile"]) == (12.5, 17.5)
    assert apple["skewness"] is None and apple["kurtosis"] is None
    assert values(profile.numeric_stats(df.drop(PRICE)), "column") == [(TOTAL,), (TOTAL,)]
    assert values(profile.numeric_stats(df, [PRICE]), "column") == [(PRICE,), (PRICE,)]
    assert profile.numeric_stats(df.limit(0)).isEmpty()
    assert profile.numeric_stats(df, ["Discount"]).isEmpty()


def test_bias_corrected_moments(spark):
    rows = [("a", v) for v in (10, 20, 40, 90, 95)] + [("b", 7)] * 5
    df = spark.createDataFrame(rows, f"`{PRODUCT}` string, `{TOTAL}` long")
    found = {r[PRODUCT]: r for r in profile.numeric_stats(df).collect()}
    assert found["a"].skewness == pytest.approx(0.3021, abs=1e-4)
    assert found["a"].kurtosis == pytest.approx(-2.9207, abs=1e-4)
    assert (found["b"].skewness, found["b"].kurtosis, found["b"]["std"]) == (0, 0, 0)


def test_statistics_document(spark, tmp_path):
    path = write_stats(profile.numeric_stats(stats_input(spark)), str(tmp_path / "stats"))
    assert path.endswith("stats.json")
    documents = [json.loads(r.value) for r in spark.read.text(path).collect()]
    merged = {k: v for d in documents for k, v in d.items()}
    assert set(merged) == {"Apple", "Banana"}
    assert list(merged["Apple"][TOTAL]) == profile.STATISTICS
    assert merged["Banana"][TOTAL]["mean"] == 10


def test_failures_file(spark, tmp_path):
    df = spark.createDataFrame([("Apple", "ten", None), ("Pear", "3", "2023-01-01")], TEXT)
    path = str(tmp_path / "failures.csv")
    write_failures(df, path)
    row = spark.read.option("header", True).csv(path).first()
    assert row.anomaly_reason == "Total Quantity must be numeric; Date cannot be null"


def test_header_names_with_commas(spark, tmp_path):
    header = ",".join(f'"{c}"' for c in RAW_COLUMNS)
    (tmp_path / "a.csv").write_text(f'"note, with comma",{header}\n' + "x," * len(RAW_COLUMNS) + "x\n")
    found = validate.file_verdicts(read_lines(spark, str(tmp_path)), list_files(spark, str(tmp_path))).first()
    assert (found.valid, found.error, found.rows) == (True, None, 1)
