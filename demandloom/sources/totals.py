"""Daily totals over all files, kept up to date when files are delivered again.

Two tables below one folder: ``parts`` holds what every file gives, one partition per file, and
``totals`` the sums per (day, product), one partition per month.  A delivery is turned into signed
rows: what its files give now, less what they gave before.  Their sums are added to the totals, and
only the months they touch are read and written, whatever the number of files and months there is.

A delivery has a number, larger than those before it; a month remembers the last one it took.  The
totals are written first, the parts of the files afterwards, so a delivery that was cut off is
run again with the same number: months that have it are left alone, the others take it.

Defined results: a file delivered again replaces all it gave; a file without rows (listed in
``files``) gives nothing any more; a total vanishes with the last file that gives it, a total of
zero does not; null quantities count as zero; rows of one file that repeat a (day, product) are added; rows
without a day are kept in a month of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.schema import DATE, PRODUCT, SOURCE_FILE, TOTAL
from demandloom.session import remove_path, stage
from demandloom.sources.writers import source_key

MONTH = "month"
NO_MONTH = "none"
_PARTS = f"`{SOURCE_FILE}` string, `{DATE}` date, `{PRODUCT}` string, `{TOTAL}` long, source_key string"
_TOTALS = f"`{DATE}` date, `{PRODUCT}` string, `{TOTAL}` long, files long, delivery long, {MONTH} string"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one before the first delivery."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def _replace(df: DataFrame, path: str, key: str, touched: DataFrame) -> None:
    """Overwrite the partitions of ``df``; those of ``touched`` that have no row any more are deleted."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    # One name after the other: the driver never holds them all.
    for row in touched.join(df.select(key).distinct(), key, "left_anti").toLocalIterator():
        remove_path(df.sparkSession, f"{path}/{key}={row[0]}")


def signed_rows(new: DataFrame, old: DataFrame) -> DataFrame:
    """(Date, Product Name, Total Quantity, files): what the totals gain or lose, rows without effect left out."""
    columns = [F.col(DATE), F.col(f"`{PRODUCT}`")]
    gained = new.select(*columns, F.col(f"`{TOTAL}`"), F.lit(1).cast("long").alias("files"))
    lost = old.select(*columns, (-F.col(f"`{TOTAL}`")).alias(TOTAL), F.lit(-1).cast("long").alias("files"))
    summed = gained.unionByName(lost).groupBy(DATE, PRODUCT).agg(F.sum(TOTAL).alias(TOTAL), F.sum("files").alias("files"))
    return summed.where((F.col(TOTAL) != 0) | (F.col("files") != 0))


def deliver(daily: DataFrame, files: DataFrame, path: str, delivery: int) -> None:
    """Take the ``daily`` rows (source_file, Date, Product Name, Total Quantity) of the listed ``files`` (file_path)."""
    spark = daily.sparkSession
    keys = stage(files.select(F.col("file_path").alias(SOURCE_FILE)).distinct().withColumn("source_key", source_key(F.col(SOURCE_FILE))), "delivered")
    new = stage(
        daily.join(keys.select(SOURCE_FILE), SOURCE_FILE, "left_semi")
        .groupBy(SOURCE_FILE, F.to_date(F.col(DATE)).alias(DATE), PRODUCT)
        .agg(F.coalesce(F.sum(TOTAL), F.lit(0)).cast("long").alias(TOTAL))
        .withColumn("source_key", source_key(F.col(SOURCE_FILE))),
        "parts",
    )
    # The key is the partition: only folders of delivered files are read.
    old = _table(spark, f"{path}/parts", _PARTS).join(keys.select("source_key"), "source_key", "left_semi")
    month = F.coalesce(F.date_format(DATE, "yyyy-MM"), F.lit(NO_MONTH))
    change = stage(signed_rows(new, old).withColumn(MONTH, month), "change")
    totals = _table(spark, f"{path}/totals", _TOTALS)
    touched = change.select(MONTH).distinct()
    before = totals.join(touched, MONTH, "left_semi")
    taken = before.where(F.col("delivery") >= delivery).select(MONTH).distinct()
    open_months = stage(touched.join(taken, MONTH, "left_anti"), "months")
    both = before.drop("delivery").unionByName(change).join(open_months, MONTH, "left_semi")
    after = both.groupBy(MONTH, DATE, PRODUCT).agg(F.sum(TOTAL).alias(TOTAL), F.sum("files").alias("files"))
    after = after.where(F.col("files") > 0).withColumn("delivery", F.lit(delivery).cast("long"))
    _replace(stage(after.select(DATE, PRODUCT, TOTAL, "files", "delivery", MONTH), "totals"), f"{path}/totals", MONTH, open_months)
    _replace(new, f"{path}/parts", "source_key", keys.select("source_key"))


def daily_totals(spark: SparkSession, path: str) -> DataFrame:
    """(Date, Product Name, Total Quantity) over the last delivery of every file."""
    return _table(spark, f"{path}/totals", _TOTALS).select(DATE, PRODUCT, TOTAL)
