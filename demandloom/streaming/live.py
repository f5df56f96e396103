"""Continuous daily demand whose result does not depend on how the stream is cut into batches.

Rows of one transaction ID are ordered by event time, then file, then place in the file.  A
row is a duplicate if the row of its ID before it is at most ``lateness`` older.  A row
is final once the watermark, the largest event time less ``lateness``, has passed it: no
row that comes on time can stand before it any more.  Until then it is kept as state,
together with the last final time of every ID that can still matter; older state expires.
Rows older than the watermark on arrival are late and go to a table of their own.

The engine's own stateful operators drop late rows before any code sees them, so the state
is a written table, one version per batch: a batch that is retried reads the same version
again and replaces what it wrote.  All steps are joins and windows: a hot ID is
split by time, since only rows of one lateness period and the one before it are compared.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandloom.operators.clean import coerce_types, keep_products, standardize_dates, tidy_products
from demandloom.schema import BLOCK, BRONZE, DATE, PRODUCT, QUANTITY, SEQ, SOURCE_FILE, TOTAL, TX_ID
from demandloom.session import remove_path, stage, staged_scope
from demandloom.sources.readers import CSV_OPTIONS
from demandloom.streaming.ingest import POLL_INTERVAL

LATENESS = timedelta(days=2)
#: Most batches that files which wait already are cut into.
CATCH_UP_BATCHES = 16
STATE = f"id string, at timestamp_ntz, {SOURCE_FILE} string, {BLOCK} long, {SEQ} long, `{PRODUCT}` string, `{QUANTITY}` long, done boolean"
MARK = "watermark timestamp_ntz"
DAILY = f"`{DATE}` date, `{PRODUCT}` string, `{TOTAL}` long"


def stream_transactions(spark: SparkSession, path: str, fmt: str = "json", max_files: int = 1000) -> DataFrame:
    """Raw text transactions from files that name their fields, with the file of every row."""
    reader = spark.readStream.schema(BRONZE).format(fmt).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    return (
        reader.option("recursiveFileLookup", True).load(path)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias(BLOCK))
    )


def files_per_batch(files: int, batches: int = CATCH_UP_BATCHES) -> int:
    """Files of one batch, so that so many files that wait are done in at most ``batches``.

    Every batch writes the state anew, which is all rows until the watermark moves: with a
    fixed number of files a batch the work would grow as the square of the files.
    """
    return max(1, -(-files // batches))


def _arrived(batch: DataFrame) -> DataFrame:
    """Typed rows of known products with a time; a row without ID is nobody's duplicate."""
    placed = batch.withColumn(SEQ, F.monotonically_increasing_id())
    known = keep_products(tidy_products(coerce_types(standardize_dates(placed)))).where(F.col(DATE).isNotNull())
    own = F.concat_ws("\u0001", F.lit(""), SOURCE_FILE, BLOCK, SEQ)
    return known.select(
        F.coalesce(TX_ID, own).alias("id"), F.col(DATE).alias("at"), SOURCE_FILE, BLOCK, SEQ, PRODUCT, QUANTITY,
        F.lit(False).alias("done"),
    )


def mark_duplicates(rows: DataFrame, lateness: timedelta) -> DataFrame:
    """Adds ``duplicate``; ``rows`` has (id, at, source_file, row_block, row_seq, done, ...).

    The rows of an ID are compared inside a period of the lateness' length; of the period
    before only the last time matters, which is one row per ID and period.
    """
    span = int(lateness.total_seconds())
    period = F.floor(F.unix_micros(F.col("at").cast("timestamp")) / (span * 1_000_000))
    cut = rows.withColumn("_period", period)
    ends = cut.groupBy(F.col("id").alias("_id"), (F.col("_period") + 1).alias("_next")).agg(F.max("at").alias("_end"))
    # What is final stands first among rows of one place and time.
    order = Window.partitionBy("id", "_period").orderBy("at", F.desc("done"), SOURCE_FILE, BLOCK, SEQ)
    joined = cut.withColumn("_before", F.lag("at").over(order)).join(
        ends, (F.col("id") == F.col("_id")) & (F.col("_period") == F.col("_next")), "left"
    )
    before = F.coalesce("_before", "_end")
    recent = F.coalesce(F.col("at") <= before + F.expr(f"INTERVAL {span} SECOND"), F.lit(False))
    return joined.withColumn("duplicate", recent).drop("_period", "_before", "_id", "_next", "_end")


def _moment(at: datetime) -> Column:
    return F.lit(at).cast("timestamp_ntz")


def _totals(rows: DataFrame) -> DataFrame:
    kept = rows.where("not done and not duplicate")
    return kept.groupBy(F.to_date("at").alias(DATE), PRODUCT).agg(F.sum(QUANTITY).alias(TOTAL))


class LiveDemand:
    """The tables of one live job below ``root``: daily partials, late rows, and the state's versions."""

    def __init__(self, spark: SparkSession, root: str, lateness: timedelta = LATENESS):
        self.spark, self.root, self.lateness = spark, root.rstrip("/"), lateness

    def _path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def _state(self, batch_id: int) -> tuple[DataFrame, datetime | None]:
        """State and watermark after a batch; nothing before the first."""
        if batch_id < 0:
            return self.spark.createDataFrame([], STATE), None
        mark = self.spark.read.schema(MARK).parquet(self._path("watermark", batch_id)).first()
        return self.spark.read.schema(STATE).parquet(self._path("state", batch_id)), mark.watermark if mark else None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with staged_scope(self.spark):
            state, watermark = self._state(batch_id - 1)
            rows = stage(_arrived(batch), "arrived")
            late = rows.where(F.col("at") < _moment(watermark)) if watermark else rows.limit(0)
            late.drop("done").write.mode("overwrite").parquet(self._path("late", batch_id))
            on_time = rows.where(F.col("at") >= _moment(watermark)) if watermark else rows
            newest = on_time.agg(F.max("at")).first()[0]
            moved = max((m for m in (watermark, newest and newest - self.lateness) if m), default=None)
            marked = stage(mark_duplicates(state.unionByName(on_time), self.lateness), "marked")
            # Nothing is final before the first row has come.
            final = marked.where(F.col("at") < _moment(moved)) if moved else marked.limit(0)
            _totals(final).write.mode("overwrite").parquet(self._path("daily", batch_id))
            self._keep(marked, moved, batch_id)
        if batch_id > 1:
            # A retry needs the version before its own, no older one.
            remove_path(self.spark, self._path("state", batch_id - 2))

    def _keep(self, marked: DataFrame, moved: datetime | None, batch_id: int) -> None:
        columns = [f"`{f.name}`" for f in self.spark.createDataFrame([], STATE).schema.fields]
        if moved:
            pending = marked.where(F.col("at") >= _moment(moved)).select(*columns)
            # Of the final rows only the last time of an ID can make a later row a duplicate.
            recent = marked.where((F.col("at") < _moment(moved)) & (F.col("at") >= _moment(moved - self.lateness)))
            last = recent.groupBy("id").agg(F.max("at").alias("at")).select(
                "id", "at", F.lit("").alias(SOURCE_FILE), F.lit(0).cast("long").alias(BLOCK), F.lit(0).cast("long").alias(SEQ),
                F.lit(None).cast("string").alias(PRODUCT), F.lit(None).cast("long").alias(QUANTITY), F.lit(True).alias("done"),
            )
            kept = pending.unionByName(last)
        else:
            kept = marked.select(*columns)
        kept.write.mode("overwrite").parquet(self._path("state", batch_id))
        self.spark.createDataFrame([(moved,)], MARK).write.mode("overwrite").parquet(self._path("watermark", batch_id))

    def start(self, rows: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        """Follow a stream of ``stream_transactions``: every minute, or ``once`` for what is there now."""
        trigger = {"availableNow": True} if once else {"processingTime": POLL_INTERVAL}
        return (
            rows.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )

    def final_daily(self) -> DataFrame:
        """Daily demand of the rows that are final."""
        partials = self.spark.read.schema(DAILY).parquet(f"{self.root}/daily")
        return partials.groupBy(DATE, PRODUCT).agg(F.sum(TOTAL).alias(TOTAL))

    def last_batch(self) -> int:
        """The number of the last batch that is done; the watermark is written last."""
        return self.spark.read.schema(MARK).parquet(f"{self.root}/watermark").agg(F.max("batch_id")).first()[0]

    def current_daily(self) -> DataFrame:
        """Daily demand as it stands after the last batch: final rows and, provisionally, the pending ones."""
        state, _ = self._state(self.last_batch())
        pending = _totals(mark_duplicates(state, self.lateness))
        both = self.final_daily().unionByName(pending.select(DATE, PRODUCT, TOTAL))
        return both.groupBy(DATE, PRODUCT).agg(F.sum(TOTAL).alias(TOTAL))

    def late_rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/late")
