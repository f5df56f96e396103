"""Every operator as a query over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.operators import aggregate, anomalies, clean, dedup, demand, drift, evaluate
from demandloom.operators import features, ordering, prices, profile, series, smoothing, validate
from demandloom.plans import monitoring, retail, views
from demandloom.schema import (
    DATE,
    PRICE,
    PRODUCER,
    PRODUCT,
    QUANTITY,
    RAW_COLUMNS,
    SEQ,
    SOURCE_FILE,
    STORE,
    TOTAL,
    TX_ID,
)
from demandloom.session import configure, scratch_path, stage
from demandloom.functions.text import processed_name
from demandloom.sources import documents, listing, manifest, ranges, readers, totals, writers
from demandloom.sources.ledger import read_ledger
from demandloom.streaming import live
from demandloom.streaming.ingest import clean_arriving_files, stream_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, with the session settings applied first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


def rounded(df: DataFrame, digits: int = 6, columns: list[str] | None = None) -> DataFrame:
    """Round doubles, so that the order of additions does not show."""
    chosen = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType) and (columns is None or f.name in columns)
    ]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in chosen})


# --- cleaning -------------------------------------------------------------


@query
def daily_demand(spark, sf_dir):
    typed = views.typed_events(spark, sf_dir)
    known = clean.keep_products(clean.tidy_products(typed))
    return aggregate.daily_demand(clean.drop_incomplete(known))


@query
def clean_types(spark, sf_dir):
    return views.typed_events(spark, sf_dir)


@query
def lowercase_strings(spark, sf_dir):
    return clean.lowercase_strings(views.lines(spark, sf_dir))


@query
def product_names(spark, sf_dir):
    raw = views.raw_events(spark, sf_dir).select(
        SOURCE_FILE, SEQ, F.col(PRODUCT).alias("raw_name"), PRODUCT
    )
    return clean.tidy_products(raw)


@query
def date_cascade(spark, sf_dir):
    raw = views.raw_events(spark, sf_dir).select(
        SOURCE_FILE, SEQ, F.col(DATE).alias("raw_date"), DATE
    )
    return clean.standardize_dates(raw)


@query
def calendar_features(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias(DATE))
    return clean.add_calendar_parts(events)


@query
def week_parts(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return clean.add_week_parts(orders, "o_orderdate").select(
        "o_orderkey", "Year", "Month", "Week_of_year"
    )


@query
def filter_products(spark, sf_dir):
    typed = clean.tidy_products(views.typed_events(spark, sf_dir))
    return clean.keep_products(typed).select(SOURCE_FILE, SEQ, PRODUCT, QUANTITY)


@query
def drop_invalid(spark, sf_dir):
    typed = views.typed_events(spark, sf_dir)
    return clean.drop_incomplete(typed).select(SOURCE_FILE, SEQ, PRODUCT, QUANTITY)


# --- prices, dates, duplicates --------------------------------------------


@query
def price_mode_week(spark, sf_dir):
    return prices.frequent_price(clean.add_week_parts(views.lines(spark, sf_dir)), prices.WEEK)


@query
def price_mode_month(spark, sf_dir):
    return prices.frequent_price(clean.add_week_parts(views.lines(spark, sf_dir)), prices.MONTH)


@query
def price_mode_year(spark, sf_dir):
    return prices.frequent_price(clean.add_week_parts(views.lines(spark, sf_dir)), prices.YEAR)


@query
def price_ladder(spark, sf_dir):
    return prices.fill_missing_prices(views.lines(spark, sf_dir))


@query
def date_order(spark, sf_dir):
    return ordering.date_order(views.parsed_events(spark, sf_dir))


@query
def fill_dates(spark, sf_dir):
    raw = views.raw_events(spark, sf_dir).select(SOURCE_FILE, SEQ, TX_ID, DATE)
    return ordering.fill_missing_dates(raw)


@query
def dedup_transactions(spark, sf_dir):
    return dedup.first_per_key(views.lines(spark, sf_dir))


@query
def duplicate_count(spark, sf_dir):
    return dedup.duplicate_count(views.lines(spark, sf_dir))


# --- anomalies ------------------------------------------------------------


@query
def iqr_bounds(spark, sf_dir):
    lines = views.lines(spark, sf_dir)
    long = lines.select(
        PRODUCT,
        F.to_date(DATE).alias("date_only"),
        F.col(PRICE).alias("price"),
        F.col(QUANTITY).cast("double").alias("quantity"),
    ).unpivot([PRODUCT, "date_only"], ["price", "quantity"], "measure", "value")
    return rounded(anomalies.iqr_bounds(long, [PRODUCT, "date_only", "measure"], "value"))


def _anomaly_query(kind: str) -> Query:
    def build(spark, sf_dir):
        flagged = anomalies.flag_anomalies(views.lines(spark, sf_dir))
        return anomalies.anomaly_set(flagged, kind).drop("datetime")

    build.__name__ = kind
    return query(build)


for _kind in anomalies.KINDS:
    _anomaly_query(_kind)


@query
def anomaly_union(spark, sf_dir):
    flagged = anomalies.flag_anomalies(views.lines(spark, sf_dir))
    return anomalies.anomaly_union(flagged).drop("datetime", "date_only", "hour")


@query
def clean_transactions(spark, sf_dir):
    return anomalies.clean_rows(anomalies.flag_anomalies(views.lines(spark, sf_dir)))


@query
def zscore(spark, sf_dir):
    lines = views.lines(spark, sf_dir).select(TX_ID, PRODUCT, QUANTITY, DATE)
    return rounded(anomalies.zscores(lines, QUANTITY, [PRODUCT]))


# --- validation and profile -----------------------------------------------


@query
def post_validate_rows(spark, sf_dir):
    return validate.failing_rows(views.daily_text(spark, sf_dir))


@query
def post_validate_summary(spark, sf_dir):
    summary = validate.validation_summary(views.daily_text(spark, sf_dir))
    return summary.withColumns(
        {c: F.concat_ws(", ", c) for c in ("results", "missing_columns")}
    )


@query
def numeric_stats(spark, sf_dir):
    return rounded(profile.numeric_stats(views.lines(spark, sf_dir), [QUANTITY, PRICE]))


@query
def daily_stats(spark, sf_dir):
    return rounded(profile.numeric_stats(views.daily(spark, sf_dir)))


@query
def quality_profile(spark, sf_dir):
    return rounded(profile.quality_profile(views.raw_events(spark, sf_dir)), 9)


# --- features, forecasts, drift -------------------------------------------


@query
def lag_rolling_features(spark, sf_dir):
    return rounded(features.time_series_features(views.daily(spark, sf_dir)))


@query
def window_new(spark, sf_dir):
    return monitoring.new_window(views.daily(spark, sf_dir))


@query
def window_ref(spark, sf_dir):
    return monitoring.reference_window(views.daily(spark, sf_dir))


@query
def forecast_metrics(spark, sf_dir):
    pairs = evaluate.pair_forecasts(
        views.daily(spark, sf_dir), views.predictions(spark, sf_dir)
    )
    return rounded(evaluate.forecast_metrics(pairs))


@query
def ks_statistic(spark, sf_dir):
    lines = views.lines(spark, sf_dir)
    early = F.col(DATE) < F.lit("1998-06-01").cast("timestamp_ntz")
    stats = drift.ks_statistics(
        lines.where(early), lines.where(~early), [PRODUCT], [QUANTITY, PRICE]
    )
    return rounded(stats.drop("gap"), 9)


def _windows(spark, sf_dir):
    daily = stage(views.daily(spark, sf_dir), "daily")
    return monitoring.reference_window(daily), monitoring.new_window(daily)


@query
def data_drift(spark, sf_dir):
    ref, new = _windows(spark, sf_dir)
    found = drift.data_drift(ref, new, [TOTAL])
    return found.withColumn("drift_columns", F.concat_ws(", ", "drift_columns"))


@query
def ks_p_value(spark, sf_dir):
    ref, new = _windows(spark, sf_dir)
    tested = drift.ks_drift(ref, new, [PRODUCT], [TOTAL])
    return rounded(tested.drop("gap", "drift", "column", "method"), 9)


@query
def concept_drift(spark, sf_dir):
    ref, new = _windows(spark, sf_dir)
    y_hat = views.predictions(spark, sf_dir)
    return drift.concept_drift(
        evaluate.residuals(evaluate.pair_forecasts(ref, y_hat)),
        evaluate.residuals(evaluate.pair_forecasts(new, y_hat)),
    )


def _report(spark, sf_dir):
    daily = stage(views.daily(spark, sf_dir), "daily")
    y_hat = stage(views.predictions(spark, sf_dir), "predictions")
    return monitoring.product_report(daily, y_hat)


@query
def monitoring_report(spark, sf_dir):
    return rounded(_report(spark, sf_dir).drop("drift_columns"))


@query
def retrain_decision(spark, sf_dir):
    return rounded(monitoring.retrain_decision(_report(spark, sf_dir)))


# --- series ---------------------------------------------------------------


@query
def daily_spine(spark, sf_dir):
    return views.spine(spark, sf_dir)


@query
def recent_series(spark, sf_dir):
    return series.recent_series(stage(views.daily(spark, sf_dir), "daily"))


@query
def forward_filled_series(spark, sf_dir):
    return series.forward_filled_series(views.daily(spark, sf_dir))


@query
def dickey_fuller(spark, sf_dir):
    return rounded(series.dickey_fuller(views.spine(spark, sf_dir)))


@query
def stationarity(spark, sf_dir):
    return rounded(series.stationarity(views.spine(spark, sf_dir)))


@query
def seasonal_baseline(spark, sf_dir):
    found = series.seasonal_baseline(views.spine(spark, sf_dir))
    return rounded(rounded(found, 6, ["mae", "mse", "rmse", "mape"]), 5, ["aic"])


@query
def seasonal_forecast(spark, sf_dir):
    return series.seasonal_forecast(stage(views.spine(spark, sf_dir), "spine"))


@query
def smoothed_baseline(spark, sf_dir):
    found = smoothing.smoothed_baseline(views.spine(spark, sf_dir))
    return rounded(rounded(found, 6, ["mae", "mse", "rmse", "mape"]), 4, ["aic"])


@query
def smoothed_forecast(spark, sf_dir):
    return rounded(smoothing.smoothed_forecast(views.spine(spark, sf_dir)))


# --- demand modelling -----------------------------------------------------


@query
def inflation_price(spark, sf_dir):
    year = F.year("o_orderdate") + 8
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        year.alias("year"),
        demand.inflation_price(F.col("o_totalprice"), F.lit(2005), year).alias("price"),
    )


@query
def unpivot_demand(spark, sf_dir):
    long = views.daily(spark, sf_dir).withColumnRenamed(TOTAL, "demand")
    wide = demand.demand_to_wide(long, clean.REFERENCE_PRODUCTS)
    return demand.demand_to_long(wide, clean.REFERENCE_PRODUCTS)


@query
def business_hours(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day")
    )
    return demand.spread_over_day(orders, "day", "o_orderkey")


@query
def price_influence(spark, sf_dir):
    lines = views.lines(spark, sf_dir).select(TX_ID, DATE, PRODUCT, PRICE)
    return rounded(demand.price_influence(lines, PRICE), 6, ["influence"])


@query
def demand_composition(spark, sf_dir):
    day, key = F.to_date("l_shipdate"), F.col("l_orderkey")
    slot = demand.weekday_slot(day, F.lit("1995-01-01").cast("date"))
    shock = demand.weekend_shock(day, F.when(key % 5 == 0, 1.5))
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        demand.compose_demand(
            F.col("l_quantity"),
            F.col("l_discount"),
            slot * 0.05 + 0.8,
            shock,
            (F.col("l_linenumber") - 4) * 2.5,
        ).alias("demand"),
    )


# --- sources, versions, whole jobs ----------------------------------------


@query
def version_diff(spark, sf_dir):
    """The documents against a version in which some are moved and some edited."""
    docs, i = views.table(spark, sf_dir, "documents"), F.col("doc_id")
    path = F.concat_ws("/", "source", "doc_id")
    moved = F.when(i % 10 == 3, F.concat(F.lit("moved/"), path)).otherwise(path)
    edited = F.when(i % 7 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    old = docs.select(path.alias("file_path"), F.md5("text").alias("digest"))
    new = docs.select(moved.alias("file_path"), F.md5(edited).alias("digest"))
    return manifest.diff_versions(old, new)


@query
def content_digest(spark, sf_dir):
    """Whole numbers and texts only: SQL engines write other types differently."""
    return listing.content_digest(views.lines(spark, sf_dir).select(QUANTITY, TX_ID, STORE, PRODUCT, PRODUCER), [PRODUCT])


def _text_files(docs: DataFrame, label: str) -> str:
    """A folder of files of document texts, one line each, in order of their ids, 16 files."""
    path = scratch_path(docs.sparkSession, label)
    text = F.concat_ws(" ", F.col("doc_id").cast("string"), F.translate(F.coalesce("text", F.lit("")), "\r\n", "  "))
    named = docs.select("doc_id", F.concat(F.lit("part"), F.pmod("doc_id", F.lit(16))).alias("file"), text.alias("value"))
    (
        named.repartition("file").sortWithinPartitions("file", "doc_id").select("file", "value")
        .write.partitionBy("file").text(path)
    )
    return path


@query
def file_inventory(spark, sf_dir):
    """Files of document texts."""
    files = listing.inventory(spark, _text_files(views.table(spark, sf_dir, "documents"), "texts"))
    return files.select(F.regexp_extract("file_path", "(part[0-9]+)", 1).alias("file"), "size", "digest")


@query
def range_diff(spark, sf_dir):
    """Byte ranges that differ between two folders of document texts: some letters replaced, one file
    gone, one new, one without its last texts."""
    docs, i = views.table(spark, sf_dir, "documents"), F.col("doc_id")
    edited = F.when(i % 97 == 5, F.translate("text", "ae", "ea")).otherwise(F.col("text"))
    old = docs.where(i % 16 != 3)
    new = docs.where((i % 16 != 7) & ~((i % 16 == 2) & (i > 500))).withColumn("text", edited)
    trees = []
    for label, table in (("texts-old", old), ("texts-new", new)):
        found = ranges.digest_tree(ranges.block_digests(spark, _text_files(table, label), 4096))
        trees.append(found.withColumn("file_path", F.regexp_extract("file_path", "(part[0-9]+)", 1)))
    return ranges.diff_ranges(*trees, 4096)


def _slim(df: DataFrame) -> DataFrame:
    """Prices as numbers: SQL engines write them differently."""
    return df.select(*RAW_COLUMNS).withColumn(PRICE, F.col(PRICE).cast("double"))


@query
def csv_source(spark, sf_dir):
    path = scratch_path(spark, "export") + ".csv"
    writers.write_table(views.raw_events(spark, sf_dir).select(*RAW_COLUMNS), path)
    return _slim(readers.read_files(spark, path))


def _breaking(raw: DataFrame) -> DataFrame:
    """Store names with line breaks, quotes and commas, among plain ones."""
    number = F.regexp_extract(TX_ID, r"(\d+)", 1).cast("long")
    odd = F.concat(F.lit('Main "St", '), F.col(STORE), F.lit("\n\nsecond, floor\n"))
    return raw.withColumn(STORE, F.when(number % 3 == 0, odd).when(number % 3 == 1, F.concat(F.col(STORE), F.lit('\n"'))).otherwise(F.col(STORE)))


@query
def quoted_csv(spark, sf_dir):
    """Records with line breaks inside quotes, read by many tasks."""
    path = scratch_path(spark, "export") + ".csv"
    writers.write_table(_breaking(views.raw_events(spark, sf_dir)).select(*RAW_COLUMNS), path)
    return _slim(readers.read_csv_records(spark, path))


@query
def quoted_verdicts(spark, sf_dir):
    """Files with line breaks inside quotes are judged by their records."""
    inbox = _export_files(_breaking(views.raw_events(spark, sf_dir)), RAW_COLUMNS)
    verdicts, _ = retail.pre_validate(spark, inbox)
    return verdicts.select(_source_name("file_path").alias(SOURCE_FILE), "rows", "error", "valid")


@query
def folder_quoted(spark, sf_dir):
    """The folder job on such files: the same daily demand as without the line breaks."""
    output = scratch_path(spark, "processed")
    inbox = _export_files(_breaking(views.raw_events(spark, sf_dir)), RAW_COLUMNS)
    retail.process_folder(spark, inbox, output, scratch_path(spark, "ledger"))
    return _published(spark, output)


@query
def json_source(spark, sf_dir):
    path = scratch_path(spark, "export")
    writers.write_table(views.raw_events(spark, sf_dir).select(*RAW_COLUMNS), path, "json")
    return _slim(readers.read_files(spark, path, "jsonl"))


def _export_documents(df: DataFrame, frames: str = "false") -> str:
    """One JSON document per source: an array in row order, or columns where ``frames`` holds.

    A source is a small file in these tables.
    """
    path = scratch_path(df.sparkSession, "documents")
    numbered = df.withColumn("_row", F.row_number().over(Window.partitionBy(SOURCE_FILE).orderBy(SEQ)) - 1)
    listed = numbered.where(~F.expr(frames)).select(
        SOURCE_FILE, F.lit(0).alias("_col"), "_row", F.to_json(F.struct(*[F.col(f"`{c}`") for c in RAW_COLUMNS])).alias("_text")
    )
    cell = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(f"`{c}`").alias("v")), {"ignoreNullFields": "false"}), r"(?s)\A\{\"v\":(.*)\}\z", 1)
    members = numbered.where(frames).select(
        SOURCE_FILE, "_row", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("name"), cell(c).alias("v")) for i, c in enumerate(RAW_COLUMNS)])).alias("m")
    )
    keyed = F.concat(F.lit('"'), F.col("_row"), F.lit('": '), F.col("m.v"))
    column = F.concat(F.lit('"'), F.col("m.name"), F.lit('": {'))
    named = F.when(F.col("_row") > 0, keyed).when(F.col("m.i") == 0, F.concat(column, keyed)).otherwise(F.concat(F.lit("},"), column, keyed))
    framed = members.select(SOURCE_FILE, F.col("m.i").alias("_col"), "_row", named.alias("_text"))
    kinds = listed.withColumn("_ends", F.array(F.lit("["), F.lit("]"))).unionByName(framed.withColumn("_ends", F.array(F.lit("{"), F.lit("}}"))))
    order = Window.partitionBy(SOURCE_FILE).orderBy("_col", "_row")
    glue = F.when(F.lag("_row").over(order).isNull(), F.col("_ends")[0]).when(F.col("_text").startswith("},"), "").otherwise(",")
    tail = F.when(F.lead("_row").over(order).isNull(), F.col("_ends")[1]).otherwise("")
    lines = kinds.select(SOURCE_FILE, "_col", "_row", F.concat(glue, "_text", tail).alias("value"))
    # Lines as they are: the other options only switch off what the writer of delimited text would add.
    raw_text = {"extension": "json", "quote": "\u0000", "escape": "\u0000", "sep": "\u0001", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.repartition(SOURCE_FILE).sortWithinPartitions(SOURCE_FILE, "_col", "_row").select(SOURCE_FILE, "value").write.options(**raw_text).partitionBy(SOURCE_FILE).csv(path)
    return path


def _odd_stores(raw: DataFrame) -> DataFrame:
    """Store names with brackets, quotes, commas and backslashes, among plain ones."""
    number = F.regexp_extract(TX_ID, r"(\d+)", 1).cast("long")
    odd = F.concat(F.lit('a "b" }, {'), F.col(STORE), F.lit("],\\"))
    return raw.withColumn(STORE, F.when(number % 3 == 0, odd).otherwise(F.col(STORE)))


@query
def json_array_source(spark, sf_dir):
    """Arrays of objects, each cut and read by many tasks."""
    path = _export_documents(_odd_stores(views.raw_events(spark, sf_dir)))
    return _slim(documents.read_json_array(spark, path))


@query
def json_columns_source(spark, sf_dir):
    """Column documents, cut into members and turned into rows by their row key."""
    path = _export_documents(_odd_stores(views.raw_events(spark, sf_dir)), "true")
    return _slim(documents.read_json_columns(spark, path))


@query
def folder_json(spark, sf_dir):
    """The folder job on JSON documents, every second one by columns: the same daily demand as from CSV."""
    output = scratch_path(spark, "processed")
    inbox = _export_documents(views.raw_events(spark, sf_dir), f"cast(regexp_extract({SOURCE_FILE}, '([0-9]+)', 1) as long) % 2 = 1")
    retail.process_folder(spark, inbox, output, scratch_path(spark, "ledger"))
    return _published(spark, output)


def _export_files(df: DataFrame, columns: list[str]) -> str:
    """One CSV file per source, rows in order; a source is a small file in these tables."""
    path = scratch_path(df.sparkSession, "inbox")
    (
        df.select(SOURCE_FILE, SEQ, *columns)
        .repartition(SOURCE_FILE)
        .sortWithinPartitions(SOURCE_FILE, SEQ)
        .drop(SEQ)
        .write.options(**writers.WRITE_OPTIONS["csv"])
        .partitionBy(SOURCE_FILE)
        .csv(path)
    )
    return path


def _source_name(path: str) -> F.Column:
    return F.regexp_extract(path, r"(batch_\d+)", 1)


def _verdicts(spark, sf_dir):
    raw = views.raw_events(spark, sf_dir)
    odd = F.regexp_extract(SOURCE_FILE, r"(\d+)", 1).cast("long") % 2 == 1
    complete = _export_files(raw.where(~odd), RAW_COLUMNS)
    partial = _export_files(
        raw.where(odd), [c for c in RAW_COLUMNS if c not in (PRICE, "Producer ID")]
    )
    files = listing.list_files(spark, complete).unionByName(listing.list_files(spark, partial))
    lines = readers.read_lines(spark, [complete, partial])
    return validate.file_verdicts(lines, files)


@query
def file_verdicts(spark, sf_dir):
    return _verdicts(spark, sf_dir).select(
        _source_name("file_path").alias(SOURCE_FILE), "rows", "error", "valid"
    )


@query
def batch_status(spark, sf_dir):
    return validate.batch_status(_verdicts(spark, sf_dir))


def _batch(spark, sf_dir) -> retail.BatchResult:
    return retail.run_batch(views.raw_events(spark, sf_dir))


@query
def pipeline_rows(spark, sf_dir):
    return _batch(spark, sf_dir).flagged.select(
        SOURCE_FILE, SEQ, DATE, PRODUCT, PRICE, QUANTITY, *anomalies.KINDS
    )


@query
def pipeline_anomalies(spark, sf_dir):
    return _batch(spark, sf_dir).anomalies.select(
        SOURCE_FILE, SEQ, TX_ID, PRODUCT, "anomaly_type"
    )


@query
def pipeline_daily(spark, sf_dir):
    return _batch(spark, sf_dir).daily


@query
def pipeline_stats(spark, sf_dir):
    return rounded(_batch(spark, sf_dir).stats())


def _published(spark, path):
    return spark.read.parquet(path).select(
        _source_name(SOURCE_FILE).alias(SOURCE_FILE), DATE, PRODUCT, TOTAL
    )


@query
def folder_pipeline(spark, sf_dir):
    """Files in, daily tables out, through the folder job and its ledger."""
    inbox = _export_files(views.raw_events(spark, sf_dir), RAW_COLUMNS)
    output = scratch_path(spark, "processed")
    retail.process_folder(spark, inbox, output, scratch_path(spark, "ledger"))
    return _published(spark, output)


@query
def stream_pipeline(spark, sf_dir):
    """The same files picked up by a stream."""
    inbox = _export_files(views.raw_events(spark, sf_dir), RAW_COLUMNS)
    output = scratch_path(spark, "streamed")
    job = clean_arriving_files(
        stream_files(spark, inbox),
        output,
        scratch_path(spark, "checkpoint"),
        scratch_path(spark, "verdicts"),
        once=True,
    )
    job.awaitTermination()
    return _published(spark, output)


@query
def redelivery(spark, sf_dir):
    """Daily totals after files were delivered again: odd ones changed, every third one shrunk, every seventh empty."""
    typed = views.typed_events(spark, sf_dir)
    daily = aggregate.daily_demand(clean.drop_incomplete(clean.keep_products(clean.tidy_products(typed))), [SOURCE_FILE])
    final = stage(daily.withColumn("_no", F.regexp_extract(SOURCE_FILE, r"(\d+)", 1).cast("long")), "final")
    odd, third, seventh = (F.col("_no") % k == r for k, r in ((2, 1), (3, 0), (7, 2)))
    wrong = final.withColumn(TOTAL, F.when(odd, F.col(TOTAL) * 2 + 1).otherwise(F.col(TOTAL)))
    files = final.select(F.col(SOURCE_FILE).alias("file_path"), "_no").distinct()
    path = scratch_path(spark, "totals")
    totals.deliver(wrong, files, path, 1)
    totals.deliver(final, files.where(odd), path, 2)
    totals.deliver(final.where(F.col(PRODUCT) < "d"), files.where(third), path, 3)
    totals.deliver(final.limit(0), files.where(seventh), path, 4)
    return totals.daily_totals(spark, path)


@query
def live_daily(spark, sf_dir):
    """Files of transactions as a live stream in at most ``live.CATCH_UP_BATCHES`` batches; every ID counts once in two months."""
    inbox = _export_files(views.raw_events(spark, sf_dir), RAW_COLUMNS)
    job = live.LiveDemand(spark, scratch_path(spark, "live"), timedelta(days=60))
    rows = live.stream_transactions(spark, inbox, "csv", max_files=live.files_per_batch(listing.list_files(spark, inbox).count()))
    job.start(rows, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    return job.current_daily()


def _bad_inbox(spark, sf_dir) -> str:
    """Every second file has a quantity that is no number."""
    odd = F.regexp_extract(SOURCE_FILE, r"(\d+)", 1).cast("long") % 2 == 1
    raw = views.raw_events(spark, sf_dir)
    return _export_files(raw.withColumn(QUANTITY, F.when(odd, "a dozen").otherwise(F.col(QUANTITY))), RAW_COLUMNS)


@query
def folder_bad_values(spark, sf_dir):
    """Files with a bad cell are left aside; the others are cleaned as if alone."""
    output = scratch_path(spark, "processed")
    retail.process_folder(spark, _bad_inbox(spark, sf_dir), output, scratch_path(spark, "ledger"))
    return _published(spark, output)


@query
def bad_value_verdicts(spark, sf_dir):
    """The ledger names the reason for every file that was left aside."""
    book = scratch_path(spark, "ledger")
    retail.process_folder(spark, _bad_inbox(spark, sf_dir), scratch_path(spark, "processed"), book)
    return read_ledger(spark, book).select(_source_name("file_path").alias(SOURCE_FILE), "error")


@query
def batch_report(spark, sf_dir):
    report = validate.batch_report(_verdicts(spark, sf_dir))
    reason = F.nullif(F.regexp_extract("line", "(Missing columns: .*)$", 1), F.lit(""))
    return report.select(_source_name("file_path").alias(SOURCE_FILE), "section", reason.alias("reason"))


@query
def sql_window(spark, sf_dir):
    """A SQL text with two scalar subqueries on a view of the session."""
    views.daily(spark, sf_dir).createOrReplaceTempView("daily_demand_view")
    return readers.read_query(
        spark,
        f"""SELECT * FROM daily_demand_view
            WHERE `{DATE}` > (SELECT max(`{DATE}`) FROM daily_demand_view) - INTERVAL 7 DAY
              AND `{TOTAL}` >= (SELECT avg(`{TOTAL}`) FROM daily_demand_view)""",
    )


@query
def required_columns(spark, sf_dir):
    lines = views.lines(spark, sf_dir)
    absent = validate.missing_columns(lines, [DATE, TOTAL, PRODUCT])
    return validate.mark_missing(lines, absent).select(TX_ID, F.concat_ws("; ", "reasons").alias("reasons"))


@query
def file_names(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    path = F.concat(F.lit("in/box/"), F.col("source"), F.lit(" "), F.col("doc_id") % 50, F.lit(".v2.json"))
    return docs.select(processed_name(path).alias("output_name")).distinct()


@query
def stats_document(spark, sf_dir):
    """The statistics document of the daily demand, written and read back."""
    path = writers.write_stats(profile.numeric_stats(views.daily(spark, sf_dir)), scratch_path(spark, "stats"))
    entries = F.from_json("value", "map<string, map<string, map<string, double>>>")
    products = spark.read.text(path).select(F.explode(entries).alias(PRODUCT, "columns"))
    columns = products.select(PRODUCT, F.explode("columns").alias("column", "entry"))
    return rounded(columns.select(PRODUCT, "column", *[F.col("entry")[k].alias(k) for k in profile.STATISTICS]))


@query
def version_log(spark, sf_dir):
    """Three versions of the documents appended to a log: all, some gone and some edited, none."""
    docs, path = views.table(spark, sf_dir, "documents"), scratch_path(spark, "versions")
    edited = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    for day, table in ((1, docs), (2, docs.where("doc_id % 10 <> 3").withColumn("text", edited)), (3, docs.where("doc_id is null"))):
        files = table.select(
            F.concat_ws("/", "source", "doc_id").alias("file_path"),
            F.octet_length("text").cast("long").alias("size"),
            F.md5("text").alias("digest"),
            F.timestamp_seconds(F.lit(0)).alias("updated"),
        )
        manifest.append_version(files, path, f"2024-01-0{day} 00:00:00")
    log = manifest.read_manifest(spark, path)
    return manifest.version_documents(log).select("file_path", "document")


@query
def version_success(spark, sf_dir):
    """Whether a version of the documents of each source would count as made, when short texts are left out."""
    docs = views.table(spark, sf_dir, "documents")
    long_texts = docs.where(F.length("text") > 1000)
    every, some = docs.select("doc_id"), long_texts.select("doc_id")
    return (
        manifest.versioning_succeeded(every, some).select(F.lit("long texts").alias("case"), "success")
        .unionByName(manifest.versioning_succeeded(every, docs.where("doc_id is null")).select(F.lit("nothing").alias("case"), "success"))
        .unionByName(manifest.versioning_succeeded(docs.where("doc_id is null"), docs.where("doc_id is null")).select(F.lit("none found").alias("case"), "success"))
    )


@query
def empty_daily(spark, sf_dir):
    """A daily table of which no row is left: a message, but no error."""
    none = views.daily_text(spark, sf_dir).where(F.length(TOTAL) < 0)
    return validate.validation_summary(none).withColumns(
        {c: F.concat_ws(", ", c) for c in ("results", "missing_columns")}
    )


@query
def post_validation(spark, sf_dir):
    """Verdict, failing rows and statistics of the daily demand, with every 50th day's demand taken back."""
    taken = F.when(F.dayofyear(DATE) % 50 == 0, -F.col(TOTAL)).otherwise(F.col(TOTAL))
    passed, failing, stats = retail.post_validate(stage(views.daily(spark, sf_dir).withColumn(TOTAL, taken), "daily"))
    counts = failing.groupBy(PRODUCT, "anomaly_reason").agg(F.count(F.lit(1)).alias("failing"))
    return rounded(stats.select(PRODUCT, "mean", "min", "max").join(counts, PRODUCT, "left").withColumn("passed", F.lit(passed)))


@query
def base_price(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast("double")
    known = F.when(F.col("p_partkey") % 3 == 0, price * 2 + 0.004)
    return part.select("p_partkey", demand.base_price(known, price).alias("price"))


@query
def forward_fill(spark, sf_dir):
    """Two columns with gaps, each carried forward by itself."""
    daily = views.daily(spark, sf_dir)
    gaps = daily.withColumns(
        {
            TOTAL: F.when(F.dayofmonth(DATE) % 3 != 0, F.col(TOTAL)),
            "weekly": F.when(F.weekday(DATE) == 0, F.col(TOTAL)),
        }
    )
    return ordering.forward_fill(gaps, [TOTAL, "weekly"], [PRODUCT], DATE)
