"""JSON documents, one array of objects or one object of columns, read by many tasks.

A document need not have line breaks, so it is cut at a character instead: an array at
every ``}``, a column document at every ``,``.  The reader can start at any byte, and the pieces
between two such characters are its rows.  Whether the character of a piece counts depends on all
text before it: on being inside a string, and on how deep the brackets are nested.  A piece
turns the first by the parity of its quotes and moves the second by one of two sums, for either
state it may begin in.  Parities and sums add up along a block (the byte range of a reader task) in
a window, and along the file with one row per block, so no task reads more than its block.

An array record begins where the depth is one or less, outside strings.  Pieces that are whole
records, as those of flat objects are, are not grouped; the others are grouped by record.
A column document, ``{"column": {"row": value, ...}, ...}``, is cut into members, each
belongs to the last column name before it, and members are turned into rows by their row key.

Defined results: values come as text, numbers in JSON's shortest spelling, nested values as JSON, null
as null; of a name or row key that is there twice the last one counts; rows are in the order their key
first appears; a key that some columns lack has nulls there.  Files that break off, have
something else between or after the records, or a record that is no object are ``broken``: they
are reported and no row of theirs is to be used.  Empty files have no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.schema import BLOCK, RAW_COLUMNS, SEQ, SOURCE_FILE
from demandloom.session import stage
from demandloom.sources.listing import scanned_file

# The characters documents are cut at.
RECORD_END, MEMBER_END = "}", ","
# A JSON string with its content as a group; possessive, so linear and without recursion.
_STRING = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_FIRST_RECORD = r"\A\x{FEFF}?\s*\[\s*(?=\{)"
_NEXT_RECORD = r"\A\s*,\s*(?=\{)"
_LAST_PIECE = r"\A\s*\]\s*\z"
_EMPTY_ARRAY = r"\A\x{FEFF}?\s*\[\s*\]\s*\z"
_EMPTY_COLUMNS = r"\A\x{FEFF}?\s*\{\s*\}\s*\z"
_OPENING = r"\A\x{FEFF}?\s*\{"
_COLUMN_NAME = rf"(?s)\A\s*{_STRING}\s*:\s*\{{"
_ROW_KEY = rf"(?s)\A\s*{_STRING}\s*:"


def read_pieces(spark: SparkSession, path: str | list[str], end: str) -> DataFrame:
    """(file_path, block_start, line_no, value): the text between two ``end`` characters."""
    return spark.read.option("lineSep", end).text(path, recursiveFileLookup=True).select(
        scanned_file().alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def _nesting(text: Column) -> Column:
    """Opened less closed brackets of a text without strings."""
    opened = F.length(text) - F.length(F.translate(text, "{[", ""))
    closed = F.length(text) - F.length(F.translate(text, "}]", ""))
    return (opened - closed).cast("long")


def _so_far(column: Column, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def piece_states(pieces: DataFrame, end: str, top: int) -> DataFrame:
    """Pieces with ``depth`` before and ``after``, ``inside`` a string before, ``ends`` inside one,
    ``begins`` (outside strings at depth ``top`` or less), the running ``number`` of such a beginning,
    and ``last`` (of its file).

    An escape never spans a cut: neither cutting character may follow a backslash in JSON.
    """
    block = ["file_path", "block_start"]
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    strings = r'"[^"]*+(?:"|\z)'
    marked = pieces.withColumn("_bare", bare).withColumns(
        {
            "_odd": ((F.length("_bare") - F.length(F.translate("_bare", '"', ""))) % 2).cast("long"),
            "_out": _nesting(F.regexp_replace("_bare", strings, "")),
            "_in": _nesting(F.regexp_replace(F.regexp_replace("_bare", r'\A[^"]*+(?:"|\z)', ""), strings, "")),
        }
    )
    before = Window.partitionBy(*block).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    turned = marked.withColumn("_turned", _so_far(F.col("_odd"), before) % 2)
    drop = 1 if end == RECORD_END else 0

    def step(start: int) -> Column:
        state = (F.col("_turned") + start) % 2
        after = (state + F.col("_odd")) % 2
        return F.when(state == 1, F.col("_in")).otherwise(F.col("_out")) - F.when(after == 0, drop).otherwise(0)

    stepped = turned.withColumns({"_step0": step(0), "_step1": step(1)})
    summed = stage(
        stepped.withColumns({f"_sum{s}": _so_far(F.col(f"_step{s}"), before) for s in (0, 1)}).drop("_bare", "_out", "_in"),
        "pieces",
    )
    # One row per block from here on.
    along = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        summed.groupBy(*block)
        .agg(F.sum("_odd").alias("odd"), F.sum("_step0").alias("s0"), F.sum("_step1").alias("s1"), F.max("line_no").alias("_end"))
        .withColumn("_start", _so_far(F.col("odd"), along) % 2)
        .withColumn("_base", _so_far(F.when(F.col("_start") == 1, F.col("s1")).otherwise(F.col("s0")), along))
        .withColumn("_last", F.max("block_start").over(Window.partitionBy("file_path")) == F.col("block_start"))
        .select(*block, "_start", "_base", "_last", "_end")
    )
    state = (F.col("_turned") + F.col("_start")) % 2
    started = F.col("_start") == 1
    depth = F.col("_base") + F.when(started, F.col("_sum1")).otherwise(F.col("_sum0"))
    known = summed.join(blocks, block).select(
        *block, "line_no", "value", depth.alias("depth"),
        (depth + F.when(started, F.col("_step1")).otherwise(F.col("_step0"))).alias("after"),
        (state == 1).alias("inside"),
        ((state + F.col("_odd")) % 2 == 1).alias("ends"),
        (F.col("_last") & (F.col("line_no") == F.col("_end"))).alias("last"),
    )
    known = stage(known.withColumn("begins", ~F.col("inside") & (F.col("depth") <= top)), "states")
    counts = known.groupBy(*block).agg(F.count_if("begins").alias("n"))
    counts = counts.select(*block, _so_far(F.col("n"), along).alias("_before"))
    so_far = Window.partitionBy(*block).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum(F.col("begins").cast("long")).over(so_far)
    return known.join(counts, block).withColumn("number", F.col("_before") + running).drop("_before")


def _grouped(pieces: DataFrame, end: str) -> DataFrame:
    """Pieces with the same number as one text each, placed where it begins; a group is one record."""
    parts = F.sort_array(F.collect_list(F.struct("block_start", "line_no", "value")))
    place = F.struct("block_start", "line_no")
    return (
        pieces.groupBy("file_path", "number")
        .agg(
            F.min(place).alias("_at"),
            F.array_join(F.transform(parts, lambda p: p["value"]), end).alias("value"),
            F.min_by("depth", place).alias("depth"),
            F.max_by("after", place).alias("after"),
            F.bool_or("last").alias("last"),
            F.max_by("ends", place).alias("ends"),
        )
        .select("file_path", "_at.block_start", "_at.line_no", "number", "value", "depth", "after", "last", "ends")
    )


def array_records(pieces: DataFrame) -> DataFrame:
    """(file_path, block_start, line_no, value, broken) of array documents cut at ``}``.

    ``value`` is the text of one object.  A file has one more row, without value, for its end, so
    that files without records and files that break off show.
    """
    states = stage(piece_states(pieces, RECORD_END, 1), "pieces")
    place = ["file_path", "block_start", "line_no"]
    closed = ~F.col("ends") & (F.col("after") == 1)
    whole = F.col("begins") & closed & ~F.col("last")
    single = states.where(whole).select(*place, "number", "value", F.lit(False).alias("open"))
    several = _grouped(states.where(~whole & ~F.col("last")), RECORD_END).select(
        *place, "number", "value", (~closed).alias("open")
    )
    every = single.unionByName(several)
    opening = F.when(F.col("number") == 1, F.lit(_FIRST_RECORD)).otherwise(F.lit(_NEXT_RECORD))
    text = F.concat(F.regexp_replace("value", opening, F.lit("")), F.lit(RECORD_END))
    records = every.select(*place, text.alias("value"), (F.col("open") | ~F.regexp_like("value", opening)).alias("broken"))
    ended = F.when(F.col("number") == 1, F.col("value").rlike(_EMPTY_ARRAY)).otherwise(
        F.col("begins") & (F.col("depth") == 1) & F.col("value").rlike(_LAST_PIECE)
    )
    tails = states.where("last").select(*place, F.lit(None).cast("string").alias("value"), (~F.coalesce(ended, F.lit(False))).alias("broken"))
    return records.unionByName(tails)


def _plain(fragment: Column) -> Column:
    """(v, _corrupt_record): the text of a JSON value."""
    return F.from_json(F.concat(F.lit('{"v":'), fragment, F.lit("}")), "v string, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})


def column_cells(pieces: DataFrame) -> DataFrame:
    """(file_path, block_start, line_no, column, key, value, broken) of column documents cut at ``,``.

    Members have a key; a column without members is a row without key.
    """
    states = stage(piece_states(pieces, MEMBER_END, 2), "pieces")
    columns = ["file_path", "block_start", "line_no", "number", "value", "depth", "after", "last", "ends"]
    whole = F.col("begins") & ~F.col("ends") & (F.col("after") <= 2)
    single = states.where(whole).select(*columns)
    members = single.unionByName(_grouped(states.where(~whole), MEMBER_END))
    first, names = F.col("number") == 1, F.col("depth") <= 1
    inner = F.when(first, F.regexp_replace("value", _OPENING, "")).otherwise(F.col("value"))
    empty = first & F.col("value").rlike(_EMPTY_COLUMNS)
    cut = members.withColumns(
        {
            "_inner": inner,
            "_empty": empty,
            "_odd": ~empty
            & (
                F.col("ends")
                | (F.when(F.col("last"), F.col("after") != 0).otherwise(~F.col("after").isin(1, 2)))
                | (first & ~F.col("value").rlike(_OPENING))
                | (names & ~inner.rlike(_COLUMN_NAME))
            ),
        }
    )
    named = cut.withColumns(
        {
            "_name": F.when(names & ~F.col("_empty") & ~F.col("_odd"), _plain(F.concat(F.lit('"'), F.regexp_extract("_inner", _COLUMN_NAME, 1), F.lit('"')))["v"]),
            "_member": F.when(names, F.regexp_replace("_inner", _COLUMN_NAME, "")).otherwise(F.col("_inner")),
        }
    )
    # Brackets that close the column (and the document) are no part of the value.
    closers = F.when(F.col("after") == 1, r"\s*\}\s*\z").when(F.col("after") == 0, r"\s*\}\s*\}\s*\z").otherwise(r"\z")
    member = F.regexp_replace("_member", closers, F.lit(""))
    bare = named.withColumn("_member", member)
    keyed = bare.withColumns(
        {
            "_none": F.col("_empty") | (names & (F.trim("_member") == "")),
            "_key": _plain(F.concat(F.lit('"'), F.regexp_extract("_member", _ROW_KEY, 1), F.lit('"'))),
            "_value": _plain(F.regexp_replace("_member", _ROW_KEY, "")),
        }
    )
    wrong = ~F.col("_none") & (
        ~F.col("_member").rlike(_ROW_KEY) | F.col("_key._corrupt_record").isNotNull() | F.col("_value._corrupt_record").isNotNull()
    )
    cells = stage(
        keyed.select(
            "file_path", "block_start", "line_no", "_name",
            F.when(~F.col("_none"), F.col("_key.v")).alias("key"),
            F.when(~F.col("_none"), F.col("_value.v")).alias("value"),
            (F.col("_odd") | wrong).alias("broken"),
        ),
        "cells",
    )
    # The last column name before a member: along its block, else from the blocks before.
    block = ["file_path", "block_start"]
    along = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*block).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lasts = cells.groupBy(*block).agg(F.max_by("_name", F.when(F.col("_name").isNotNull(), F.col("line_no"))).alias("n"))
    carried = lasts.select(*block, F.last("n", True).over(along).alias("_carry"))
    return cells.join(carried, block).select(
        *block, "line_no", F.coalesce(F.last("_name", True).over(upto), "_carry").alias("column"), "key", "value", "broken"
    )


def array_rows(spark: SparkSession, path: str | list[str], columns: list[str] = RAW_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(rows, findings) of array documents: text columns picked by name, and (file_path, rows, has, broken).

    ``has`` lists which of ``columns`` are in any record of the file.
    """
    records = array_records(read_pieces(spark, path, RECORD_END))
    kinds = ", ".join(f"`{c}` string" for c in [*columns, "_corrupt_record"])
    parsed = records.withColumns(
        {
            "_row": F.from_json("value", kinds, {"columnNameOfCorruptRecord": "_corrupt_record"}),
            "_keys": F.json_object_keys("value"),
        }
    )
    rows = stage(
        parsed.select(
            F.col("file_path").alias(SOURCE_FILE), F.col("block_start").alias(BLOCK), F.col("line_no").alias(SEQ),
            *[F.col(f"_row.`{c}`").alias(c) for c in columns],
            F.col("value").isNotNull().alias("_real"),
            F.array_intersect("_keys", F.array(*[F.lit(c) for c in columns])).alias("_has"),
            (F.col("broken") | F.col("_row._corrupt_record").isNotNull()).alias("_broken"),
        ),
        "documents",
    )
    present = [F.when(F.bool_or(F.array_contains("_has", c)), F.lit(c)) for c in columns]
    verdicts = rows.groupBy(F.col(SOURCE_FILE).alias("file_path")).agg(
        F.count_if("_real").alias("rows"), F.array_compact(F.array(*present)).alias("has"), F.bool_or("_broken").alias("broken")
    )
    return rows.where("_real").select(*columns, SOURCE_FILE, BLOCK, SEQ), verdicts


def column_rows(spark: SparkSession, path: str | list[str], columns: list[str] = RAW_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(rows, findings) of column documents, as ``array_rows`` gives them."""
    cells = stage(column_cells(read_pieces(spark, path, MEMBER_END)), "cells")
    place = F.struct("block_start", "line_no")
    rows = stage(
        cells.where("key is not null")
        .groupBy("file_path", "key")
        .agg(F.min(place).alias("_at"), *[F.max_by("value", F.when(F.col("column") == c, place)).alias(c) for c in columns])
        .select(*[F.col(f"`{c}`") for c in columns], F.col("file_path").alias(SOURCE_FILE), F.col("_at.block_start").alias(BLOCK), F.col("_at.line_no").alias(SEQ)),
        "documents",
    )
    counts = rows.groupBy(F.col(SOURCE_FILE).alias("file_path")).agg(F.count("*").alias("rows"))
    present = [F.when(F.bool_or(F.col("column") == c), F.lit(c)) for c in columns]
    found = cells.groupBy("file_path").agg(F.array_compact(F.array(*present)).alias("has"), F.bool_or("broken").alias("broken"))
    return rows, found.join(counts, "file_path", "left").select("file_path", F.coalesce("rows", F.lit(0)).alias("rows"), "has", "broken")


def document_rows(spark: SparkSession, paths: list[str], columns: list[str] = RAW_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(rows, findings) of documents of either kind, told apart by their first character."""
    starts = read_pieces(spark, paths, RECORD_END).groupBy("file_path").agg(
        F.min_by(F.substring(F.regexp_extract("value", r"\A\x{FEFF}?\s*([^\s])", 1), 1, 1), F.struct("block_start", "line_no")).alias("start")
    )
    # A file scan takes its paths from the driver, as any Spark listing does.
    lists = [r.file_path for r in starts.where("start <> '{'").select("file_path").collect()]
    frames = [r.file_path for r in starts.where("start = '{'").select("file_path").collect()]
    parts = [build(spark, found, columns) for build, found in ((array_rows, lists), (column_rows, frames)) if found]
    if len(parts) == 2:
        return tuple(a.unionByName(b) for a, b in zip(*parts))
    return parts[0] if parts else array_rows(spark, paths, columns)


def _sound(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    bad = verdicts.where("broken").first()
    if bad is not None:
        raise ValueError(f"no JSON document of the wanted kind: {bad.file_path}")
    return rows


def read_json_array(spark: SparkSession, path: str | list[str], columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """Array documents as text columns picked by name, with the row order columns, in many tasks."""
    return _sound(*array_rows(spark, path, columns))


def read_json_columns(spark: SparkSession, path: str | list[str], columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """Column documents as text columns picked by name, with the row order columns, in many tasks."""
    return _sound(*column_rows(spark, path, columns))
