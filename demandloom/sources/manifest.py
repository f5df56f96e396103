"""Dataset versions: which files, with which content, at which time."""

from __future__ import annotations

import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.schema import MANIFEST
from demandloom.session import stage

FILE_FIELDS = ["file_path", "size", "digest", "updated"]


def version_rows(files: DataFrame, timestamp) -> DataFrame:
    """Rows of one version.  A version without files still has one row, with a
    null path, so that it is not lost."""
    stamp = F.lit(timestamp).cast("timestamp").alias("version_ts")
    rows = files.select(stamp, *FILE_FIELDS)
    session = files.sparkSession
    marker = session.range(1).select(
        stamp, *[F.lit(None).cast(MANIFEST[c].dataType).alias(c) for c in FILE_FIELDS]
    )
    return rows if not files.isEmpty() else marker


def append_version(files: DataFrame, path: str, timestamp) -> None:
    version_rows(files, timestamp).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The version log; a missing or unreadable one starts empty."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return spark.createDataFrame([], MANIFEST)
    # The log is small; it is read here so that a corrupt part shows now.
    try:
        return stage(spark.read.schema(MANIFEST).parquet(path), "manifest")
    except (PySparkException, Py4JJavaError) as broken:
        warnings.warn(f"version log {path} can't be read and starts anew: {str(broken)[:200]}", stacklevel=2)
        return spark.createDataFrame([], MANIFEST)


def version_documents(manifest: DataFrame) -> DataFrame:
    """(version_ts, file_path, document): one JSON line per file of a version.

    Order by (version_ts, file_path) when writing.  A version without files has one
    line without a file.
    """
    entry = F.when(F.col("file_path").isNotNull(), F.struct(*FILE_FIELDS))
    stamp = F.date_format("version_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    return manifest.select("version_ts", "file_path", F.to_json(F.struct(stamp, entry.alias("file"))).alias("document"))


def diff_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file_path, change) between two file tables with path and digest."""
    before = old.where(F.col("file_path").isNotNull()).select(
        "file_path", F.col("digest").alias("old_digest")
    )
    after = new.where(F.col("file_path").isNotNull()).select(
        "file_path", F.col("digest").alias("new_digest")
    )
    change = (
        F.when(F.col("old_digest").isNull(), "added")
        .when(F.col("new_digest").isNull(), "removed")
        .when(F.col("old_digest") != F.col("new_digest"), "changed")
    )
    return (
        before.join(after, "file_path", "full_outer")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select("file_path", "change")
    )


def versioning_succeeded(found: DataFrame, versioned: DataFrame) -> DataFrame:
    """One row: at least one file was versioned, or there was none to version."""
    counts = found.select(F.lit("found").alias("side")).unionByName(
        versioned.select(F.lit("versioned").alias("side"))
    )
    return counts.agg(
        (
            (F.count_if(F.col("side") == "versioned") > 0)
            | (F.count_if(F.col("side") == "found") == 0)
        ).alias("success")
    )
