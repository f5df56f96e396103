"""File streams through the cleaning job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandloom.plans.retail import process_files
from demandloom.session import staged_scope

# Fixed value: how often new files are looked for.
POLL_INTERVAL = "1 minute"


def stream_files(
    spark: SparkSession,
    path: str,
    max_files: int = 1000,
    clean_source: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream of (file_path, size, updated).

    Only the listing is streamed; the content column is pruned and never read.
    ``clean_source`` is ``archive`` or ``delete``; by default files stay and the
    checkpoint of the query remembers them.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
    )
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.load(path).select(
        F.col("path").alias("file_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("updated"),
    )


def clean_arriving_files(
    files: DataFrame,
    output: str,
    checkpoint: str,
    verdict_table: str,
    cache: str | None = None,
    reports: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Clean CSV files as they arrive: every minute, or ``once`` for what is there now.

    A file that fails its checks is listed in ``verdict_table`` with the reason
    and does not stop the others.  Both tables are replaced per file or per
    batch, so a batch that is retried after a failure changes nothing.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        with staged_scope(batch.sparkSession):
            verdicts = process_files(batch.sparkSession, batch, output, cache, reports)
            verdicts.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch_id").parquet(verdict_table)

    trigger = {"availableNow": True} if once else {"processingTime": POLL_INTERVAL}
    return (
        files.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
