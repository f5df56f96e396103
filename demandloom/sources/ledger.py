"""Consume-once bookkeeping without deleting sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "file_path string, size long, updated timestamp, processed_at timestamp, error string"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def unprocessed(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not yet recorded with the same size and time."""
    return listing.join(ledger, ["file_path", "size", "updated"], "left_anti")


def record(listing: DataFrame, path: str) -> None:
    """Append files to the ledger after their results were written; ``error`` if they had none."""
    error = F.col("error") if "error" in listing.columns else F.lit(None).cast("string")
    listing.select(
        "file_path", "size", "updated", F.current_timestamp().alias("processed_at"), error.alias("error")
    ).write.mode("append").parquet(path)


def delete_sources(spark: SparkSession, paths: Iterable[str]) -> int:
    """Delete consumed files on explicit request; returns how many were removed."""
    jvm = spark.sparkContext._jvm
    removed = 0
    for name in paths:
        target = jvm.org.apache.hadoop.fs.Path(name)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        removed += bool(fs.delete(target, False))
    return removed
