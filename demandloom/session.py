"""Session settings and staged tables.

``stage`` is the one place where lineage is cut.  It writes a Parquet table
below ``spark.checkpoint.dir`` and reads it back, which gives three things at
once: lost executors cannot force a recompute of everything upstream, later
reads fetch only the columns they need, and the planner knows the true size of
the table, so it broadcasts a small one and shuffles a large one by itself.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_owners = threading.local()

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later operator wants the same hash
    # partitioning; the extra exchange is cheaper than one endless task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A written table is many times larger in memory: repeated texts are coded once per page.
    # Without this a join would broadcast a table by its size on disk, whatever the driver holds.
    # Tables that are small as rows are still broadcast, by adaptive execution.
    "spark.sql.sources.fileCompressionFactor": "20.0",
    # A folder of many files is listed by so many tasks, not by one for each file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # The memory of one task is that of one range of a file or one partition of a shuffle.  Both
    # keep their size as the input grows: shuffles are cut finely and put together by size.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "demandloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder of its own;
    on a cluster a machine-local folder would be wrong, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="demandloom-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the staging root."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables staged inside on leaving: for jobs whose results are written by then.

    A query that is returned lazily can't use it; its staged tables stay for the caller.
    """
    outer, _owners.paths = getattr(_owners, "paths", None), []
    try:
        yield
    finally:
        done, _owners.paths = _owners.paths, outer
        for path in done:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder through the file system of its path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    path = scratch_path(df.sparkSession, label)
    if getattr(_owners, "paths", None) is not None:
        _owners.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
