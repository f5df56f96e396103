"""File listings and inventories."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scanned_file() -> Column:
    """Path of the file a row was read from, spelled as in ``list_files``.

    The metadata column has it in URI form; a plus sign is not an escape there.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _found_files(fs, root) -> Iterator[tuple[str, int, int]]:
    """(path, size, milliseconds) of every file below a folder, or of a single file."""
    if not fs.exists(root):
        return
    if fs.getScheme() != "file":
        # One request for many files, where the store has such a request.
        found = fs.listFiles(root, True)
        while found.hasNext():
            status = found.next()
            yield status.getPath().toString(), status.getLen(), status.getModificationTime()
        return
    # A local listing with locations starts a process for each file, to ask for its permissions.
    folders = [root]
    while folders:
        for status in fs.listStatus(folders.pop()):
            if status.isDirectory():
                folders.append(status.getPath())
            else:
                yield status.getPath().toString(), status.getLen(), status.getModificationTime()


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, size, updated) of all files below a folder.

    Uses the Hadoop file system of the path, because the file sources of Spark
    do not show empty files.  Folder placeholders and hidden files are left out.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = [r for r in _found_files(fs, root) if not posixpath.basename(r[0]).startswith(("_", "."))]
    listed = spark.createDataFrame(rows, "file_path string, size long, millis long")
    return listed.select("file_path", "size", F.timestamp_millis("millis").alias("updated"))


def first_files(listing: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` files by path, for a report."""
    return listing.orderBy("file_path").limit(n)


def _half(digest: Column, at: int) -> Column:
    """Fifteen hex digits of a digest as a whole number."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(file_path, line, value): lines with their number in the file, from 1.

    Lines are counted inside a block (the byte range of a reader task), and blocks
    along the file, one row each.
    """
    inside = Window.partitionBy("file_path", "block_start").orderBy("line_no")
    along = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file_path", "block_start").agg(F.count(F.lit(1)).alias("n"))
    base = blocks.select("file_path", "block_start", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base"))
    placed = lines.withColumn("at", F.row_number().over(inside))
    return placed.join(base, ["file_path", "block_start"]).select(
        "file_path", (F.col("base") + F.col("at")).alias("line"), "value"
    )


def line_digests(numbered: DataFrame, key: str = "file_path") -> DataFrame:
    """(key, digest): count and summed MD5 halves of "number:line" over all lines.

    The number makes the sum depend on the order; a sum combines on the map side, so
    files of every size have the same definition.
    """
    marked = F.md5(F.concat(F.encode(F.concat(F.col("line").cast("string"), F.lit(":")), "utf-8"), F.col("value").cast("binary")))
    return (
        numbered.select(key, marked.alias("m"))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(_half(F.col("m"), 1)).alias("a"), F.sum(_half(F.col("m"), 16)).alias("b"))
        .select(key, F.concat_ws("-", "n", "a", "b").alias("digest"))
    )


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, size, digest, updated) of every file below a folder.

    ``digest`` is the size and the digest of the lines between line feeds, carriage
    returns included; the size tells whether the last line was ended.  It is the same
    for every file size and block size.
    """
    listed = list_files(spark, path)
    lines = spark.read.option("lineSep", "\n").text(path, recursiveFileLookup=True).select(
        scanned_file().alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )
    digests = line_digests(numbered_lines(lines))
    return listed.join(digests, "file_path", "left").select(
        "file_path",
        "size",
        F.concat_ws("-", F.col("size").cast("string"), F.coalesce("digest", F.lit("0"))).alias("digest"),
        "updated",
    )


def content_digest(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Row count and order-independent digest of table content, per key.

    The sum of the MD5 halves of each row's columns as text, joined by the unit separator
    (null is a text of its own).  A partial aggregate: works for tables of any size.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u2205")) for c in df.columns]
    hashed = df.select(*(keys or []), F.md5(F.concat_ws("\x1f", *parts)).alias("_m"))
    return hashed.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws("-", F.sum(_half(F.col("_m"), 1)), F.sum(_half(F.col("_m"), 16))).alias("digest"),
    )
