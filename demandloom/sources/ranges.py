"""Which byte ranges of which files changed between two versions, by trees of block digests.

A version is a table of trees: level 0 has the digest of every block of ``block_bytes`` bytes, and a
node of each higher level digests up to ``FANOUT`` nodes below it, up to one root per file.  Two
versions are compared from the top: a level is read only below nodes that differ, so equal
subtrees are skipped.

Files are read line by line by Spark's splittable reader; a line's place is the sum of the lengths
before it, along the byte range of a reader task and, with one row per byte range, along the file.  Lines are cut
at block bounds, and the parts of a block are added up as numbers, so no block is put
together.  A byte order mark, which the reader skips, is found by the missing bytes.

Defined results: an empty file has a root and no bytes; ranges are half open, in bytes, and
neighbouring changed blocks are one range; a file that only one version has gives one range
over all of it; a file that grew or shrank gives the rest as ``added`` or ``removed``.  Files
are plain: those that the reader would decompress are refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.session import stage
from demandloom.sources.listing import list_files, scanned_file

BLOCK_BYTES = 1 << 20
FANOUT = 16
_COMPRESSED = r"(?i)\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"


def _number(digest: Column, at: int) -> Column:
    """Fifteen hex digits of a digest as a whole number."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")


def placed_lines(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """(file_path, start, data): the bytes of every line, its line feed included, and their place in the file."""
    lines = spark.read.option("lineSep", "\n").text(path, recursiveFileLookup=True).select(
        scanned_file().alias("file_path"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("no"),
        F.col("value").cast("binary").alias("data"),
    )
    # Part and number come from one read: both depend on how it was cut into tasks.
    lines = stage(lines, "lines")
    size = F.octet_length("data").cast("long") + 1
    before = Window.partitionBy("file_path", "part").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy("file_path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = lines.groupBy("file_path", "part").agg(F.sum(size).alias("bytes"), F.min("no").alias("first"), F.max("no").alias("last"))
    # One row per byte range from here on.
    whole = Window.partitionBy("file_path")
    parts = parts.join(files.select("file_path", "size"), "file_path").select(
        "file_path", "part", "first", "last",
        F.coalesce(F.sum("bytes").over(along), F.lit(0)).alias("base"),
        (F.max("part").over(whole) == F.col("part")).alias("at_end"),
        (F.min("part").over(whole) == F.col("part")).alias("at_start"),
        (F.col("size") - F.sum("bytes").over(whole)).alias("rest"),
    )
    known = lines.withColumn("inside", F.coalesce(F.sum(size).over(before), F.lit(0))).join(parts, ["file_path", "part"])
    # The reader takes a byte order mark away (three bytes) and can't tell whether the last line was ended (one).
    mark = F.when(F.col("rest") >= 2, 3).otherwise(0)
    is_first = F.col("at_start") & (F.col("no") == F.col("first"))
    unended = F.col("at_end") & (F.col("no") == F.col("last")) & (F.col("rest") - mark == -1)
    data = F.concat(
        F.when(is_first & (mark > 0), F.unhex(F.lit("EFBBBF"))).otherwise(F.unhex(F.lit(""))),
        F.col("data"),
        F.when(unended, F.unhex(F.lit(""))).otherwise(F.unhex(F.lit("0A"))),
    )
    start = F.col("base") + F.col("inside") + F.when(is_first, 0).otherwise(mark)
    return known.select("file_path", start.alias("start"), data.alias("data"))


def block_digests(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file_path, node, size, digest) of every block of every file below ``path``."""
    files = stage(list_files(spark, path), "files")
    if not files.where(F.col("file_path").rlike(_COMPRESSED)).isEmpty():
        raise ValueError(f"compressed files below {path}: their bytes are not what the reader gives")
    lines = placed_lines(spark, path, files)
    length, offset = F.octet_length("data"), F.col("start") % block_bytes
    # The parts of a line, cut at block bounds: as many as blocks it touches.
    cuts = F.sequence(F.lit(0), ((offset + length - 1) / block_bytes).cast("int"))
    parts = lines.select("file_path", "start", "data", offset.alias("offset"), F.explode(cuts).alias("k"))
    skip = F.greatest(F.lit(0), F.col("k") * block_bytes - F.col("offset")).cast("int")
    take = (F.lit(block_bytes) - F.when(F.col("k") == 0, F.col("offset")).otherwise(0)).cast("int")
    at = F.when(F.col("k") == 0, F.col("offset")).otherwise(0)
    pieces = parts.select(
        "file_path",
        (F.floor(F.col("start") / block_bytes) + F.col("k")).alias("node"),
        at.alias("at"),
        F.substring("data", skip + 1, take).alias("piece"),
    )
    marked = F.md5(F.concat(F.encode(F.concat(F.col("at").cast("string"), F.lit(":")), "utf-8"), F.col("piece")))
    digests = pieces.select("file_path", "node", F.octet_length("piece").cast("long").alias("size"), marked.alias("m"))
    blocks = digests.groupBy("file_path", "node").agg(
        F.sum("size").alias("size"), F.sum(_number(F.col("m"), 1)).alias("a"), F.sum(_number(F.col("m"), 16)).alias("b")
    ).select("file_path", "node", "size", F.concat_ws("-", "size", "a", "b").alias("digest"))
    empty = files.where("size = 0").select("file_path", F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("size"), F.lit("0").alias("digest"))
    return blocks.unionByName(empty)


def digest_tree(blocks: DataFrame) -> DataFrame:
    """(file_path, level, node, size, digest): the blocks as level 0 and all levels above them.

    There is a level for each power of ``FANOUT`` up to the longest file.
    """
    level = stage(blocks.withColumn("level", F.lit(0)), "blocks")
    levels, top = [level], level.agg(F.max("node")).first()[0] or 0
    while top > 0:
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))
        # A node has FANOUT children at most.
        level = level.groupBy("file_path", F.floor(F.col("node") / FANOUT).alias("node")).agg(
            F.sum("size").alias("size"),
            F.md5(F.to_json(children)).alias("digest"),
            (F.max("level") + 1).alias("level"),
        )
        level = stage(level, "nodes")
        levels.append(level)
        top //= FANOUT
    columns = ["file_path", "level", "node", "size", "digest"]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in levels])


def _changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes that differ, or that one side only has: (file_path, node, old_size, new_size)."""
    before = old.select("file_path", "node", F.col("size").alias("old_size"), F.col("digest").alias("old_digest"))
    after = new.select("file_path", "node", F.col("size").alias("new_size"), F.col("digest").alias("new_digest"))
    both = before.join(after, ["file_path", "node"], "full_outer")
    return both.where(~F.col("old_digest").eqNullSafe(F.col("new_digest"))).select("file_path", "node", "old_size", "new_size")


def changed_blocks(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file_path, node, old_size, new_size) of the blocks that differ, found from the top of both trees."""
    heights = [tree.agg(F.max("level")).first()[0] for tree in (old, new)]
    # The lower tree's top: above it the other one has nodes without counterparts.
    height = min((h for h in heights if h is not None), default=0)
    found = stage(_changed(old.where(F.col("level") == height), new.where(F.col("level") == height)), "differing")
    for level in range(height - 1, -1, -1):
        parents = found.select("file_path", F.col("node").alias("_parent"))

        def below(tree: DataFrame) -> DataFrame:
            nodes = tree.where(F.col("level") == level).withColumn("_parent", F.floor(F.col("node") / FANOUT))
            return nodes.join(parents, ["file_path", "_parent"], "left_semi")

        found = stage(_changed(below(old), below(new)), "differing")
    return found


def diff_ranges(old: DataFrame, new: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file_path, change, start, end): changed byte ranges between two trees.

    ``changed`` ranges are blocks that both versions have; ``added`` and ``removed`` ones are bytes
    that one version has beyond the end of the other.
    """
    blocks = changed_blocks(old, new)
    old_size, new_size = F.coalesce("old_size", F.lit(0)), F.coalesce("new_size", F.lit(0))
    shared = F.least(old_size, new_size)
    start = F.col("node") * block_bytes
    # A block at the end of the shorter version is partly changed and partly new or gone; whether
    # its shared bytes differ is not known from its digest, so they count as changed.
    spans = F.array(
        F.struct(F.lit("changed").alias("change"), start.alias("start"), (start + shared).alias("end")),
        F.struct(
            F.when(new_size > old_size, "added").otherwise("removed").alias("change"),
            (start + shared).alias("start"),
            (start + F.greatest(old_size, new_size)).alias("end"),
        ),
    )
    rows = blocks.select("file_path", F.explode(F.filter(spans, lambda s: s["start"] < s["end"])).alias("s"))
    rows = rows.select("file_path", "s.*")
    # One row per changed block: neighbours become one range.
    by_place = Window.partitionBy("file_path", "change").orderBy("start")
    begins = (~F.lag("end").over(by_place).eqNullSafe(F.col("start"))).cast("long")
    numbered = rows.withColumn("_begins", begins)
    numbered = numbered.withColumn("_range", F.sum("_begins").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("file_path", "change", "_range").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    # A file of no bytes that one version lacks.
    empty = blocks.where("coalesce(old_size, 0) = 0 and coalesce(new_size, 0) = 0 and (old_size is null or new_size is null)")
    bare = empty.select(
        "file_path", F.when(F.col("old_size").isNull(), "added").otherwise("removed").alias("change"),
        F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"),
    )
    return merged.select("file_path", "change", "start", "end").unionByName(bare)
