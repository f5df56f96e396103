"""Transaction tables derived from the star-schema test tables.

Defects are planted by key arithmetic, so that SQL can repeat them exactly.
Each view comes in two forms: a DataFrame and the body of a SQL common table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.operators.aggregate import daily_demand
from demandloom.operators.clean import coerce_types, standardize_dates
from demandloom.operators.series import daily_spine
from demandloom.schema import (
    DATE,
    PRICE,
    PRODUCER,
    PRODUCT,
    QUANTITY,
    REFERENCE_PRODUCTS,
    SEQ,
    SOURCE_FILE,
    STORE,
    TOTAL,
    TX_ID,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _product(index: Column) -> Column:
    names = F.array(*[F.lit(p) for p in REFERENCE_PRODUCTS])
    return F.get(names, (index % len(REFERENCE_PRODUCTS)).cast("int"))


def _every(key: Column, modulus: int, rest: int) -> Column:
    return key % modulus == rest


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy text transactions in files of 2,500 rows that are in ascending,
    descending or mixed order."""
    e, i, u = table(spark, sf_dir, "events"), F.col("event_id"), F.col("user_id")
    file_no = F.floor(i / 2500)
    spelling = F.floor(i / 3) % 12
    date = (
        F.when(_every(i, 20, 0), F.lit(None))
        .when(_every(i, 97, 5), "not a date")
        .when(spelling == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(spelling == 1, F.date_format("ts", "MM-dd-yyyy"))
        .when(spelling == 2, F.date_format("ts", "dd/MM/yyyy"))
        .when(spelling == 3, F.date_format("ts", "M/d/yyyy"))
        .when(spelling == 4, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
    )
    name = _product(u)
    product = (
        F.when(_every(i, 51, 7), F.lit(None))
        .when(_every(i, 33, 0), F.translate(name, "ao", "@0"))
        .when(_every(i, 4, 0), F.concat(F.lit("\t "), F.upper(name), F.lit("  ")))
        .otherwise(name)
    )
    amount = F.when(_every(i, 101, 0), 500).when(_every(i, 67, 9), -4).otherwise(i % 23)
    quantity = F.when(~_every(i, 40, 3), F.concat(amount, F.when(i % 2 == 0, ".0").otherwise("")))
    return e.select(
        date.alias(DATE),
        F.when(~_every(i, 10, 3), F.col("value").cast("string")).alias(PRICE),
        quantity.alias(QUANTITY),
        F.concat(F.lit("TX-"), i - F.when(_every(i, 50, 7), 3).otherwise(0)).alias(TX_ID),
        F.when(_every(i, 47, 1), F.lit(None))
        .when(_every(i, 49, 0), "4711")
        .otherwise(F.concat(F.lit("Store "), u % 5))
        .alias(STORE),
        product.alias(PRODUCT),
        (u % 10 + 1).cast("string").alias(PRODUCER),
        F.concat(F.lit("batch_"), file_no).alias(SOURCE_FILE),
        F.when(file_no % 3 == 0, i).when(file_no % 3 == 1, -i).otherwise(i.bitwiseXOR(2047)).alias(SEQ),
    )


SQL_PRODUCTS = "[" + ", ".join(f"'{p}'" for p in REFERENCE_PRODUCTS) + "]"
SQL_PRODUCT_SET = "(" + ", ".join(f"'{p}'" for p in REFERENCE_PRODUCTS) + ")"

SQL_RAW = f"""raw AS (
  SELECT
    CASE WHEN event_id % 20 = 0 THEN NULL
         WHEN event_id % 97 = 5 THEN 'not a date'
         WHEN (event_id // 3) % 12 = 0 THEN strftime(ts, '%Y-%m-%d')
         WHEN (event_id // 3) % 12 = 1 THEN strftime(ts, '%m-%d-%Y')
         WHEN (event_id // 3) % 12 = 2 THEN strftime(ts, '%d/%m/%Y')
         WHEN (event_id // 3) % 12 = 3 THEN strftime(ts, '%-m/%-d/%Y')
         WHEN (event_id // 3) % 12 = 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS "Date",
    CASE WHEN event_id % 10 <> 3 THEN value END AS price,
    CASE WHEN event_id % 40 <> 3 THEN
      CASE WHEN event_id % 101 = 0 THEN 500 WHEN event_id % 67 = 9 THEN -4
           ELSE event_id % 23 END END AS quantity,
    CASE WHEN event_id % 2 = 0 THEN '.0' ELSE '' END AS quantity_suffix,
    'TX-' || (event_id - CASE WHEN event_id % 50 = 7 THEN 3 ELSE 0 END) AS "Transaction ID",
    CASE WHEN event_id % 47 = 1 THEN NULL WHEN event_id % 49 = 0 THEN '4711'
         ELSE 'Store ' || (user_id % 5) END AS "Store Location",
    CASE WHEN event_id % 51 = 7 THEN NULL
         WHEN event_id % 33 = 0 THEN translate({SQL_PRODUCTS}[user_id % 8 + 1], 'ao', '@0')
         WHEN event_id % 4 = 0 THEN chr(9) || ' ' || upper({SQL_PRODUCTS}[user_id % 8 + 1]) || '  '
         ELSE {SQL_PRODUCTS}[user_id % 8 + 1] END AS "Product Name",
    CAST(user_id % 10 + 1 AS VARCHAR) AS "Producer ID",
    'batch_' || (event_id // 2500) AS source_file,
    CASE WHEN (event_id // 2500) % 3 = 0 THEN event_id
         WHEN (event_id // 2500) % 3 = 1 THEN -event_id
         ELSE xor(event_id, 2047) END AS row_seq
  FROM events)"""

SQL_PARSED = r"""parsed AS (
  SELECT * REPLACE (
    CASE WHEN regexp_full_match("Date", '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?')
           THEN TRY_CAST("Date" AS TIMESTAMP)
         WHEN regexp_full_match("Date", '\d{4}-\d{2}-\d{2}') THEN TRY_CAST("Date" AS TIMESTAMP)
         WHEN regexp_full_match("Date", '\d{2}-\d{2}-\d{4}') THEN try_strptime("Date", '%m-%d-%Y')
         WHEN regexp_full_match("Date", '\d{2}/\d{2}/\d{4}') THEN try_strptime("Date", '%d/%m/%Y')
         WHEN regexp_full_match("Date", '\d{1,2}/\d{1,2}/\d{4}') THEN try_strptime("Date", '%m/%d/%Y')
         WHEN regexp_full_match("Date", '\d{1,2}-\d{1,2}-\d{4}') THEN try_strptime("Date", '%m-%d-%Y')
    END AS "Date")
  FROM raw)"""


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_dates(raw_events(spark, sf_dir))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_types(parsed_events(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions with repeated IDs, missing prices and returns."""
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    moment = F.timestamp_add(
        "MINUTE", (o % 24) * 60 + n * 7, F.col("l_shipdate").cast("timestamp_ntz")
    )
    amount = F.col("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        moment.alias(DATE),
        F.when(o % 10 != 0, F.floor(F.col("l_extendedprice") / 1000) * 10.0).alias(PRICE),
        F.when(_every(o, 40, 1), F.lit(None))
        .when(_every(o, 50, 2), -amount)
        .otherwise(amount)
        .alias(QUANTITY),
        F.concat_ws("-", o, n).alias(TX_ID),
        F.concat(F.lit("Store "), F.col("l_suppkey") % 5).alias(STORE),
        _product(F.col("l_partkey")).alias(PRODUCT),
        F.col("l_suppkey").cast("string").alias(PRODUCER),
    )


SQL_LINES = f"""lines AS (
  SELECT
    l_shipdate + to_minutes((l_orderkey % 24) * 60 + l_linenumber * 7) AS "Date",
    CASE WHEN l_orderkey % 10 <> 0 THEN floor(l_extendedprice / 1000) * 10.0 END AS "Unit Price",
    CASE WHEN l_orderkey % 40 = 1 THEN NULL
         WHEN l_orderkey % 50 = 2 THEN -CAST(l_quantity AS BIGINT)
         ELSE CAST(l_quantity AS BIGINT) END AS "Quantity",
    l_orderkey || '-' || l_linenumber AS "Transaction ID",
    'Store ' || (l_suppkey % 5) AS "Store Location",
    {SQL_PRODUCTS}[l_partkey % 8 + 1] AS "Product Name",
    CAST(l_suppkey AS VARCHAR) AS "Producer ID"
  FROM lineitem)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_demand(lines(spark, sf_dir))


SQL_DAILY = f"""{SQL_LINES}, daily AS (
  SELECT CAST("Date" AS DATE) AS "Date", "Product Name",
         CAST(coalesce(sum("Quantity"), 0) AS BIGINT) AS "Total Quantity"
  FROM lines GROUP BY ALL)"""


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_spine(daily(spark, sf_dir))


SQL_SPINE = f"""{SQL_DAILY}, calendar AS (
  SELECT "Product Name", CAST(unnest(generate_series(min("Date"), max("Date"), INTERVAL 1 DAY)) AS DATE) AS "Date"
  FROM daily GROUP BY "Product Name"),
spine AS (
  SELECT "Product Name", "Date", coalesce("Total Quantity", 0) AS "Total Quantity"
  FROM calendar LEFT JOIN daily USING ("Product Name", "Date"))"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast of a day: the demand one week earlier."""
    by_day = Window.partitionBy(PRODUCT).orderBy(DATE)
    return (
        spine(spark, sf_dir)
        .select(PRODUCT, DATE, F.lag(TOTAL, 7).over(by_day).cast("double").alias("y_hat"))
        .where(F.col("y_hat").isNotNull())
    )


SQL_PREDICTIONS = f"""{SQL_SPINE}, lagged AS (
  SELECT "Product Name", "Date",
         CAST(lag("Total Quantity", 7) OVER (PARTITION BY "Product Name" ORDER BY "Date") AS DOUBLE) AS y_hat
  FROM spine),
predictions AS (SELECT * FROM lagged WHERE y_hat IS NOT NULL)"""


def daily_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows as text with invalid products, quantities and dates."""
    i = F.col(SEQ)
    raw = raw_events(spark, sf_dir)
    amount = (
        F.when(F.abs(i) % 29 == 0, "ten")
        .when(F.abs(i) % 31 == 0, "-5")
        .otherwise(F.col(QUANTITY))
    )
    date = F.when(
        F.abs(i) % 37 == 0, F.regexp_replace(F.substring(DATE, 1, 10), "-", "/")
    ).otherwise(F.col(DATE))
    return raw.select(
        SOURCE_FILE, SEQ, PRODUCT, amount.alias(TOTAL), date.alias(DATE)
    )


SQL_DAILY_TEXT = f"""{SQL_RAW}, daily_text AS (
  SELECT source_file, row_seq, "Product Name",
    CASE WHEN abs(row_seq) % 29 = 0 THEN 'ten' WHEN abs(row_seq) % 31 = 0 THEN '-5'
         ELSE quantity || quantity_suffix END AS "Total Quantity",
    CASE WHEN abs(row_seq) % 37 = 0 THEN replace(substr("Date", 1, 10), '-', '/')
         ELSE "Date" END AS "Date"
  FROM raw)"""
