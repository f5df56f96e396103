"""The cleaning job: raw transactions to validated daily demand."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators.aggregate import daily_demand
from demandloom.operators.anomalies import anomaly_union, clean_rows, flag_anomalies
from demandloom.operators.clean import (
    coerce_types,
    drop_incomplete,
    keep_products,
    lowercase_strings,
    tidy_products,
)
from demandloom.operators.dedup import first_per_key
from demandloom.operators.ordering import fill_missing_dates
from demandloom.operators.prices import fill_missing_prices
from demandloom.operators.profile import numeric_stats
from demandloom.operators.validate import (
    NONE_VALID,
    add_bad_values,
    bad_values,
    batch_status,
    document_verdicts,
    failing_rows,
    file_verdicts,
    validation_summary,
)
from demandloom.schema import BLOCK, PRICE, RAW_COLUMNS, REFERENCE_PRODUCTS, SEQ, SOURCE_FILE
from demandloom.session import stage, staged_scope
from demandloom.sources.documents import document_rows
from demandloom.sources.ledger import delete_sources, read_ledger, record, unprocessed
from demandloom.sources.listing import list_files
from demandloom.sources.readers import read_lines, read_valid_csv
from demandloom.sources.records import assemble
from demandloom.sources.writers import write_per_source


@dataclass
class BatchResult:
    """Tables a batch produces: lazy views on the staged rows and their staged bounds.

    Each output reads only its own columns and repeats the (usually broadcast)
    join with the bounds, which costs less than writing all flagged rows.
    """

    flagged: DataFrame
    anomalies: DataFrame
    clean: DataFrame
    daily: DataFrame
    per: list[str]

    def failures(self) -> DataFrame:
        return failing_rows(self.daily)

    def summary(self) -> DataFrame:
        return validation_summary(self.daily)

    def stats(self) -> DataFrame:
        return numeric_stats(self.daily, per=self.per)


def prepare_rows(
    raw: DataFrame,
    products: list[str] | DataFrame = REFERENCE_PRODUCTS,
    per: list[str] | None = None,
    block: str | None = None,
    rows_per_block: int = 100_000,
) -> DataFrame:
    """Dates, types, names, prices and duplicates: everything before the screens.

    ``raw`` holds text columns plus source_file and row_seq (and ``block`` when
    row_seq is only unique inside a block).  The order of steps matters: price
    modes see rows that are dropped later, duplicates included.
    """
    dated = fill_missing_dates(raw, block=block, rows_per_block=rows_per_block)
    typed = tidy_products(lowercase_strings(coerce_types(dated)))
    known = keep_products(typed, products)
    if PRICE in known.columns:
        known = fill_missing_prices(known, per=per)
    order = [SOURCE_FILE, *([block] if block else []), SEQ]
    return first_per_key(drop_incomplete(known), order=order, per=per)


def run_batch(
    raw: DataFrame,
    products: list[str] | DataFrame = REFERENCE_PRODUCTS,
    per_file: bool = True,
    block: str | None = None,
    rows_per_block: int = 100_000,
) -> BatchResult:
    """Whole job for any number of files at once.

    With ``per_file`` every statistic is kept apart by source file, as if each
    file were cleaned alone; otherwise all rows form one batch.
    """
    per = [SOURCE_FILE] if per_file else []
    rows = stage(prepare_rows(raw, products, per, block, rows_per_block), "rows")
    flagged = flag_anomalies(rows, per=per)
    clean = clean_rows(flagged, unique_ids=True)
    return BatchResult(flagged, anomaly_union(flagged), clean, daily_demand(clean, per), per)


def post_validate(daily: DataFrame) -> tuple[bool, DataFrame, DataFrame]:
    """(passed, failing rows, profile statistics) of a daily table."""
    summary = validation_summary(daily).first()
    return not summary.has_errors, failing_rows(daily), numeric_stats(daily)


def pre_validate(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(verdict per file, batch status) for the CSV files and JSON documents of a folder."""
    files = list_files(spark, path)
    verdicts = judge_files(spark, path, files)[0]
    return verdicts, batch_status(verdicts)


def judge_files(
    spark: SparkSession, path: str | list[str], files: DataFrame
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(verdict per file, records of the CSV files that hold line breaks inside quotes, rows of the JSON documents).

    Files named ``.json`` are documents, all others CSV; what no file needs is None.
    """
    is_document = F.lower("file_path").endswith(".json")
    # A file scan takes its paths from the driver, as any Spark listing does.
    documents = [r.file_path for r in files.where(is_document).select("file_path").collect()]
    if not documents:
        return *judge_csv(spark, path, files), None
    rows, found = document_rows(spark, documents)
    verdicts = stage(document_verdicts(found, files.where(is_document)), "verdicts")
    plain = files.where(~is_document)
    paths = [r.file_path for r in plain.select("file_path").collect()]
    if not paths:
        return verdicts, None, rows
    others, records = judge_csv(spark, paths, plain)
    return verdicts.unionByName(others), records, rows


def judge_csv(spark: SparkSession, path: str | list[str], files: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(verdict per file, records of the files that hold line breaks inside quotes, if any)."""
    verdicts = stage(file_verdicts(read_lines(spark, path), files), "verdicts")
    broken = [r.file_path for r in verdicts.where("breaks").select("file_path").collect()]
    if not broken:
        return verdicts, None
    records = stage(assemble(read_lines(spark, broken)), "records")
    again = file_verdicts(records, verdicts.where("breaks").select("file_path"))
    return stage(verdicts.where("not breaks").unionByName(again), "verdicts"), records


def valid_rows(
    spark: SparkSession, verdicts: DataFrame, records: DataFrame | None, documents: DataFrame | None
) -> DataFrame | None:
    """Text rows of all valid files, of either format; None if there is no valid file."""
    raw = read_valid_csv(spark, verdicts, records)
    valid = verdicts.where("valid and header is null").select(F.col("file_path").alias(SOURCE_FILE))
    if documents is None or valid.isEmpty():
        return raw
    picked = documents.join(valid, SOURCE_FILE, "left_semi").select(*RAW_COLUMNS, SOURCE_FILE, BLOCK, SEQ)
    return picked if raw is None else raw.unionByName(picked)


def process_files(
    spark: SparkSession,
    files: DataFrame,
    output: str,
    cache: str | None = None,
    reports: str | None = None,
) -> DataFrame:
    """Clean the listed CSV files and JSON documents and return the verdict per file.

    Invalid files, those with a bad number in a cell included, do not stop the others; the
    verdict names the reason.  Every result replaces the partition of
    its own file, so running a batch again leaves the same tables.  ``reports``
    gets the tables anomalies, failures and stats.
    """
    # A file scan takes its paths from the driver, as any Spark listing does.
    paths = [r.file_path for r in files.select("file_path").collect()]
    verdicts, records, documents = judge_files(spark, paths, files)
    raw = valid_rows(spark, verdicts, records, documents)
    if raw is not None:
        verdicts = stage(add_bad_values(verdicts, bad_values(raw)), "verdicts")
        raw = valid_rows(spark, verdicts, records, documents)
    if raw is not None:
        done = verdicts.where("valid").select("file_path")
        result = run_batch(raw, block=BLOCK)
        result.daily = stage(result.daily, "daily")
        for target in [output, *([cache] if cache else [])]:
            write_per_source(result.daily, target, done)
        if reports:
            write_per_source(result.anomalies, f"{reports}/anomalies", done)
            write_per_source(result.failures(), f"{reports}/failures", done)
            write_per_source(result.stats(), f"{reports}/stats", done)
    return verdicts


def process_folder(
    spark: SparkSession,
    path: str,
    output: str,
    ledger: str,
    cache: str | None = None,
    delete_after: bool = False,
    reports: str | None = None,
    delete_invalid: bool = False,
) -> int:
    """Clean every new CSV file and JSON document of a folder and return the batch status 0, 1 or 2.

    Files are recorded in the ledger after their results are written, invalid ones
    with the reason, so that no run reads them again; deletion is opt-in.
    Intermediate tables are deleted at the end.
    """
    with staged_scope(spark):
        return _process_folder(spark, path, output, ledger, cache, delete_after, reports, delete_invalid)


def _process_folder(spark, path, output, ledger, cache, delete_after, reports, delete_invalid) -> int:
    new_files = stage(unprocessed(list_files(spark, path), read_ledger(spark, ledger)), "new-files")
    if new_files.isEmpty():
        return NONE_VALID
    verdicts = process_files(spark, new_files, output, cache, reports)
    judged = new_files.join(verdicts.select("file_path", "error", "valid"), "file_path")
    record(judged, ledger)
    for wanted, condition in ((delete_after, "valid"), (delete_invalid, "not valid")):
        if wanted:
            delete_sources(spark, (r.file_path for r in judged.where(condition).select("file_path").toLocalIterator()))
    return batch_status(verdicts).first().status
