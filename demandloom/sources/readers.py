"""Readers for raw transaction files, tables and SQL queries."""

from __future__ import annotations

import posixpath
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.schema import BLOCK, BRONZE, RAW_COLUMNS, SEQ, SOURCE_FILE
from demandloom.session import stage
from demandloom.sources.listing import scanned_file
from demandloom.sources.records import assemble, parse


#: A quote inside a quoted field is doubled.
CSV_OPTIONS = {"header": "true", "escape": '"'}


def _csv(spark: SparkSession, path, schema) -> DataFrame:
    return (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("enforceSchema", False)
        .csv(path)
    )


def _json(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _json_lines(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _parquet(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


READERS: dict[str, Callable] = {
    "csv": _csv,
    "json": _json,
    "jsonl": _json_lines,
    "parquet": _parquet,
}


def file_format(path: str) -> str:
    """Format by lower-cased extension; anything else is an error."""
    extension = posixpath.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    if extension not in READERS:
        raise ValueError("Unsupported file type")
    return extension


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    schema: T.StructType | None = BRONZE,
) -> DataFrame:
    """Read one file, several files or a folder; columns stay text by default.

    A ``json`` file is one array and is parsed by one task; ``documents.read_json_array`` and
    ``read_json_columns`` read such files by many.

    CSV columns are matched by header name and must come in schema order; see
    ``read_csv_by_name`` for files with their own column order or extra columns.
    """
    first = path if isinstance(path, str) else path[0]
    chosen = fmt or file_format(first)
    if chosen not in READERS:
        raise ValueError("Unsupported file type")
    return READERS[chosen](spark, path, schema)


def read_csv_by_name(
    spark: SparkSession, paths: str | list[str], columns: list[str] = RAW_COLUMNS
) -> DataFrame:
    """CSV files that share one header, as text columns picked by name.

    Only the header is read up front; extra columns are pruned by the scan.
    """
    table = spark.read.options(**CSV_OPTIONS).csv(paths)
    return table.select(*[F.col(f"`{c}`") for c in columns if c in table.columns])


def read_valid_csv(spark: SparkSession, verdicts: DataFrame, records: DataFrame | None = None) -> DataFrame | None:
    """All valid files of a batch, whatever the column order of each.

    Files with the same header line form one scan; row order columns are added.  Files with
    line breaks inside quotes come as ``records`` (see ``records.assemble``).
    """
    # One row per different header and kind; files of one header are one scan.
    groups = (
        verdicts.where("valid and header is not null").groupBy("header", "breaks").agg(F.collect_list("file_path").alias("paths"))
    ).collect()
    picked = []
    for g in groups:
        if g.breaks and records is not None:
            firsts = verdicts.where(F.col("valid") & F.col("breaks") & (F.col("header") == F.lit(g.header)))
            body = records.join(firsts.select("file_path", "first"), "file_path").where(
                F.struct("block_start", "line_no") != F.col("first")
            )
            rows = parse(body, g.header, RAW_COLUMNS)
            place = {"file_path": SOURCE_FILE, "block_start": BLOCK, "line_no": SEQ}
            picked.append(rows.withColumnsRenamed(place))
        else:
            scan = with_row_order(spark.read.options(**CSV_OPTIONS).csv(g.paths))
            picked.append(scan.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS], SOURCE_FILE, BLOCK, SEQ))
    return reduce(DataFrame.unionByName, picked) if picked else None


def with_row_order(df: DataFrame) -> DataFrame:
    """Add the file of every row and its place in it.

    ``row_block`` is the byte offset of the range a task read and ``row_seq``
    increases inside it, so (row_block, row_seq) is file order and a block is
    never larger than ``spark.sql.files.maxPartitionBytes``.
    Call right after reading, before any shuffle.
    """
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        scanned_file().alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SEQ),
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines as (file_path, block_start, line_no, value) for header checks."""
    return spark.read.text(path, recursiveFileLookup=True).select(
        scanned_file().alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def read_csv_records(spark: SparkSession, path: str | list[str], columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """CSV files of one header whose quoted fields may hold line breaks, as text columns in many tasks.

    The row order columns are added, as ``with_row_order`` does.
    """
    records = stage(assemble(read_lines(spark, path)).where(F.trim("value") != ""), "records")
    place = F.struct("block_start", "line_no")
    firsts = stage(
        records.groupBy("file_path").agg(F.min(place).alias("first"), F.min_by("value", place).alias("header")), "headers"
    )
    headers = [r.header for r in firsts.select("header").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError("no rows found in the input" if not headers else "the files have different headers")
    body = records.join(firsts.select("file_path", "first"), "file_path").where(place != F.col("first"))
    return parse(body, headers[0], columns).withColumnsRenamed(
        {"file_path": SOURCE_FILE, "block_start": BLOCK, "line_no": SEQ}
    )


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no rows found in the input")
    return df


def read_query(spark: SparkSession, query: str, url: str | None = None, **options: str) -> DataFrame:
    """Result of a SQL query: over JDBC with ``url``, else on the session's own views.

    Pass partitionColumn, lowerBound, upperBound and numPartitions to read a
    large JDBC result in parallel; then ``query`` must be a table or a
    parenthesised subquery with an alias.
    """
    if url is None:
        return spark.sql(query)
    source = "dbtable" if "partitionColumn" in options else "query"
    return spark.read.format("jdbc").options(url=url, **{source: query}, **options).load()
