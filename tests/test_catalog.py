"""Registered queries: contract, and a sample of them against SQL."""

from __future__ import annotations

import os

import duckdb
import pytest
from helpers import final_plan

import __spark_entry__ as spark_entry
from demandloom.plans import catalog, oracle
from tools.check_queries import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"
WITHOUT_SQL: set[str] = set()

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


def test_every_query_has_sql_unless_stated():
    assert set(catalog.QUERIES) - set(oracle.ORACLE) == WITHOUT_SQL
    assert set(oracle.ORACLE) <= set(catalog.QUERIES)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@needs_tables
@pytest.mark.parametrize(
    "name",
    ["daily_demand", "date_cascade", "fill_dates", "price_mode_month", "dedup_transactions",
     "lag_rolling_features", "ks_p_value", "stationarity", "demand_composition", "quality_profile"],
)
def test_sample_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = con.execute(spark_entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    df = spark_entry.queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(columns, cursor.fetchall())


@needs_tables
def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["Date", "Product Name", "Total Quantity"] and not df.isEmpty()


@needs_tables
def test_plans_scan_only_what_they_need(spark):
    plan = final_plan(catalog.QUERIES["price_mode_year"](spark, SF_DIR))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "l_extendedprice" in scan and "l_quantity" not in scan and "l_tax" not in scan
    windows = catalog.QUERIES["iqr_bounds"](spark, SF_DIR)
    assert "Percentile" not in final_plan(windows)


@needs_tables
def test_date_repair_reads_parsed_rows_once(spark):
    plan = final_plan(catalog.QUERIES["fill_dates"](spark, SF_DIR))
    assert " Exchange " not in plan and "lineitem" not in plan
