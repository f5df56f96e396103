"""Sinks for tables and documents."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.text import processed_name
from demandloom.operators.anomalies import anomaly_union
from demandloom.operators.profile import stats_document
from demandloom.operators.validate import failing_rows
from demandloom.schema import PRODUCT, SOURCE_FILE
from demandloom.session import remove_path, stage

WRITERS = ("csv", "json", "parquet")

# A CSV writer would otherwise strip blanks around values; quotes inside a field are doubled.
WRITE_OPTIONS = {
    "csv": {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
}


def sink_format(path: str) -> str:
    extension = posixpath.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    if extension not in WRITERS:
        raise ValueError("Unsupported file type")
    return extension


def write_table(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """Overwrite ``path`` with the table, in the format of its extension."""
    chosen = fmt or sink_format(path)
    if chosen not in WRITERS:
        raise ValueError("Unsupported file type")
    writer = df.write.mode("overwrite").options(**WRITE_OPTIONS.get(chosen, {}))
    writer.format(chosen).save(path)


def write_everywhere(df: DataFrame, paths: list[str], fmt: str | None = None) -> None:
    """The same result at several places, computed once."""
    done = stage(df, "result")
    for path in paths:
        write_table(done, path, fmt)


def source_key(name: Column) -> Column:
    """The partition of an input file: a digest of its whole path, safe as a folder name."""
    return F.md5(name)


def write_per_source(df: DataFrame, path: str, files: DataFrame | None = None, fmt: str = "parquet") -> None:
    """One output partition per input file, by its whole path; ``output_name`` is for display.

    A file delivered again replaces its own partition and no other one.  ``files``
    (file_path) lists what was processed: a file without a row left loses its old
    partition, so that no result of an earlier delivery stays.
    """
    named = df.withColumn("output_name", processed_name(F.col(SOURCE_FILE))).withColumn(
        "source_key", source_key(F.col(SOURCE_FILE))
    )
    if files is not None:
        named = stage(named, "per-source")
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**WRITE_OPTIONS.get(fmt, {})).partitionBy("source_key").format(fmt).save(path)
    if files is not None:
        keys = files.select(source_key(F.col("file_path")).alias("source_key")).distinct()
        gone = keys.join(named.select("source_key").distinct(), "source_key", "left_anti")
        # One name after the other: the driver never holds them all.
        for row in gone.toLocalIterator():
            remove_path(df.sparkSession, f"{path}/source_key={row.source_key}")


def write_stats(stats: DataFrame, path: str) -> str:
    """JSON documents ``{"<product>": {column: {statistic: value}}}``, one product per line."""
    target = path if path.endswith(".json") else f"{path}.json"
    name = F.to_json(F.array(PRODUCT))
    key = F.expr("substring(_name, 2, length(_name) - 2)")
    lines = (
        stats_document(stats)
        .withColumn("_name", name)
        .select(F.concat(F.lit("{"), key, F.lit(": "), F.col("stats"), F.lit("}")).alias("value"))
    )
    lines.write.mode("overwrite").text(target)
    return target


def write_anomalies(flagged: DataFrame, path: str) -> None:
    """All anomaly sets in one CSV table with their type."""
    write_table(anomaly_union(flagged), path, "csv")


def write_failures(df: DataFrame, path: str) -> None:
    """Rows that fail validation, with their joined reasons, as CSV."""
    write_table(failing_rows(df), path, "csv")
