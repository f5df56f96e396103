"""Delimited records whose quoted fields hold line breaks, read by many tasks.

Whether a line begins a record depends on all quotes before it.  Each line is a function of
a two-state automaton (outside or inside a quoted field): it keeps the state, turns it or
sets it.  Such functions compose along a block (the byte range of a reader task) with a
running window; one row per block, whatever its size, is composed along the file.  So the
state before every line is known though no task reads more than one block, and a
record may begin in one block and end in any later one.

Only files with a line that ends inside a quoted field take this way; all other files keep
Spark's own splittable reader.  Whole one-line records are not grouped; the lines of the
others are grouped by record.  A file that ends inside quotes has no last record: it is
reported and not put together.

Defined results: a quote opens a field only at the field's beginning; a doubled quote inside
quotes is one quote; any line end inside quotes becomes a line feed; blank lines between
records are no records; an empty file has none.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.session import stage

# A field as it stands between two commas of a record; possessive, so linear and without recursion.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+'
_COMPLETE = rf"\A{_FIELD}(?:,{_FIELD})*+\z"
_CLOSING = rf'\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+\z'


def ends_inside(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside them."""
    return ~line.rlike(_COMPLETE)


def still_inside(line: Column) -> Column:
    """Whether a line that begins inside quotes ends inside them."""
    return ~line.rlike(_CLOSING)


def _states_before(df: DataFrame, by: list[str], order: str, out_0: str, out_1: str) -> DataFrame:
    """Adds ``if_out`` and ``if_in``: the state before a row when its group begins outside or inside.

    ``out_0`` and ``out_1`` say whether the state after the row is inside, from either state.
    A row that sets the state hides all rows before it; behind it only the turns count.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sets, turns = F.col(out_0) == F.col(out_1), F.col(out_0) & ~F.col(out_1)
    counted = df.withColumn("_turns", F.coalesce(F.sum(turns.cast("long")).over(before), F.lit(0)))
    last = F.last(F.when(sets, F.struct(F.col(out_0).alias("inside"), F.col("_turns").alias("turns"))), True).over(before)
    since = F.col("_turns") - F.coalesce(F.col("_last.turns"), F.lit(0))
    odd = since % 2 == 1
    turned = lambda state: F.coalesce(F.col("_last.inside"), F.lit(state)) != odd
    return (
        counted.withColumn("_last", last)
        .withColumns({"if_out": turned(False), "if_in": turned(True)})
        .drop("_turns", "_last")
    )


def _after(state: str) -> Column:
    return F.when(F.col(state), F.col("out_1")).otherwise(F.col("out_0"))


def line_states(lines: DataFrame) -> DataFrame:
    """Lines with ``inside`` (the state before), ``ends`` (the state after), where their record begins
    (``at_block``, ``at_line``), and ``open``: whether their file ends inside quotes.

    ``lines`` has (file_path, block_start, line_no, value).
    """
    block = ["file_path", "block_start"]
    marked = lines.withColumns({"out_0": ends_inside(F.col("value")), "out_1": still_inside(F.col("value"))})
    placed = _states_before(marked, block, "line_no", "out_0", "out_1").withColumns(
        {"end_0": _after("if_out"), "end_1": _after("if_in")}
    )

    def opener(state: str, end: str) -> Column:
        return F.max(F.when(~F.col(state) & F.col(end), F.col("line_no")))

    blocks = placed.groupBy(*block).agg(
        F.max_by("end_0", "line_no").alias("out_0"),
        F.max_by("end_1", "line_no").alias("out_1"),
        opener("if_out", "end_0").alias("open_0"),
        opener("if_in", "end_1").alias("open_1"),
    )
    # One row per block from here on.
    along = _states_before(blocks, ["file_path"], "block_start", "out_0", "out_1")
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file_path")
    opened = F.when(F.col("if_out"), F.col("open_1")).otherwise(F.col("open_0"))
    along = (
        along.withColumn("_opened", F.when(opened.isNotNull(), F.struct("block_start", opened.alias("line_no"))))
        .withColumns(
            {
                "_carry": F.last("_opened", True).over(before),
                "open": F.max_by(_after("if_out"), "block_start").over(whole),
            }
        )
        .select(*block, F.col("if_out").alias("_inside"), "_carry", "open")
    )
    ordered = Window.partitionBy(*block).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    known = placed.join(along, block).withColumns(
        {
            "inside": F.when(F.col("_inside"), F.col("if_in")).otherwise(F.col("if_out")),
            "ends": F.when(F.col("_inside"), F.col("end_1")).otherwise(F.col("end_0")),
        }
    )
    begun = F.last(F.when(~F.col("inside") & F.col("ends"), F.col("line_no")), True).over(ordered)
    return known.withColumn("_begun", begun).select(
        "file_path", "block_start", "line_no", "value", "inside", "ends", "open",
        F.when(~F.col("inside") | F.col("_begun").isNotNull(), F.col("block_start"))
        .otherwise(F.col("_carry.block_start")).alias("at_block"),
        F.when(~F.col("inside"), F.col("line_no"))
        .otherwise(F.coalesce("_begun", F.col("_carry.line_no"))).alias("at_line"),
    )


def assemble(lines: DataFrame) -> DataFrame:
    """(file_path, block_start, line_no, value, open): one row per record, placed where it begins.

    Of a file that ends inside quotes only the lines that are records by themselves are there.
    """
    states = stage(line_states(lines), "lines")
    columns = ["file_path", "block_start", "line_no", "value", "open"]
    single = states.where("not inside and not ends").select(*columns)
    parts = F.sort_array(F.collect_list(F.struct("block_start", "line_no", "value")))
    several = (
        states.where("(inside or ends) and not open")
        # A group is one record.
        .groupBy("file_path", F.col("at_block").alias("block_start"), F.col("at_line").alias("line_no"), "open")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    )
    return single.unionByName(several)


def header_names(header: str) -> list[str]:
    """The column names of a header record."""
    return [name.strip().lstrip("﻿") for name in next(csv.reader(io.StringIO(header)), [])]


def parse(records: DataFrame, header: str, columns: list[str]) -> DataFrame:
    """Records of files with one header as text columns, picked by name.

    A field without text is null, as in the reader of whole files; blank records are none.
    """
    names = header_names(header)
    kinds = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"escape": '"', "multiLine": "true"}
    parsed = records.where(F.trim("value") != "").withColumn("_row", F.from_csv("value", F.lit(kinds), options))
    picked = [F.col(f"_row.c{names.index(c)}").alias(c) for c in columns if c in names]
    return parsed.select(*picked, "file_path", "block_start", "line_no")
