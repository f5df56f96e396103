"""Operators that depend on the order of rows inside a file.

Rows are cut into blocks of bounded size (a range of sequence numbers, or the
byte range a reader task got).  Windows run inside a block; one summary row per
block carries the last known and next known date across block edges.  So no
task ever holds a whole file, and a run of missing dates may span any number of
blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.operators.clean import standardize_dates
from demandloom.operators.ranking import block_start
from demandloom.schema import DATE, SEQ, SOURCE_FILE
from demandloom.session import stage

ROWS_PER_BLOCK = 100_000

# The three answers of the order check.
ASCENDING, DESCENDING, RANDOM = "Ascending", "Descending", "Random"


def _block(seq: str, block: str | None, rows_per_block: int) -> Column:
    return F.col(block) if block else block_start(F.col(seq), rows_per_block)


def _within_blocks(df, date, source, seq, block, rows_per_block):
    """Add the in-block neighbours of every row: last and next known date with their position."""
    blocked = df.where(F.col(source).isNotNull() & F.col(seq).isNotNull()).withColumn(
        "_block", F.coalesce(_block(seq, block, rows_per_block), F.lit(0))
    )
    ordered = Window.partitionBy(source, "_block").orderBy(seq)
    # Looking ahead is a backward scan: a frame that ends at unbounded following
    # would be re-evaluated for every row.
    backward = Window.partitionBy(source, "_block").orderBy(F.desc(seq))
    numbered = blocked.withColumn("_row", F.row_number().over(ordered))
    known = F.when(
        F.col(date).isNotNull(), F.struct(F.col(date).alias("at"), F.col("_row").alias("row"))
    )
    return numbered.withColumn("_known", known).withColumns(
        {
            "_last": F.last("_known", ignorenulls=True).over(
                ordered.rowsBetween(Window.unboundedPreceding, 0)
            ),
            "_next": F.last("_known", ignorenulls=True).over(
                backward.rowsBetween(Window.unboundedPreceding, 0)
            ),
            "_before": F.last("_known", ignorenulls=True).over(
                ordered.rowsBetween(Window.unboundedPreceding, -1)
            ),
        }
    )


def _block_edges(marked: DataFrame, source: str, only: str | None = None) -> DataFrame:
    """One row per block: where it starts, what surrounds it, and the order of its file.

    With ``only``, files in which that column is never set are left out.
    """
    day = F.to_date(F.col("_known.at"))
    previous_day = F.to_date(F.col("_before.at"))
    summary = marked.groupBy(source, "_block").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("_known").alias("_known_rows"),
        F.count(only or F.lit(1)).alias("_wanted_rows"),
        F.min(F.when(F.col("_known").isNotNull(), F.struct("_known.row", "_known.at"))).alias(
            "_head"
        ),
        F.max(F.when(F.col("_known").isNotNull(), F.struct("_known.row", "_known.at"))).alias(
            "_tail"
        ),
        F.coalesce(F.bool_and(day >= previous_day), F.lit(True)).alias("_up"),
        F.coalesce(F.bool_and(day <= previous_day), F.lit(True)).alias("_down"),
    )
    group = Window.partitionBy(source)
    ordered = group.orderBy("_block")
    start = F.coalesce(
        F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )

    def shifted(edge: str) -> Column:
        return F.when(
            F.col(edge).isNotNull(),
            F.struct(
                F.col(f"{edge}.at").alias("at"), (F.col("_start") + F.col(f"{edge}.row")).alias("row")
            ),
        )

    placed = summary.withColumn("_start", start).withColumns(
        {"_head": shifted("_head"), "_tail": shifted("_tail")}
    )
    carried = placed.withColumns(
        {
            "_carry_last": F.last("_tail", ignorenulls=True).over(
                ordered.rowsBetween(Window.unboundedPreceding, -1)
            ),
            "_carry_next": F.last("_head", ignorenulls=True).over(
                group.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
            ),
        }
    )
    head_day, last_day = F.to_date(F.col("_head.at")), F.to_date(F.col("_carry_last.at"))
    up = F.bool_and(F.col("_up") & F.coalesce(head_day >= last_day, F.lit(True))).over(group)
    down = F.bool_and(F.col("_down") & F.coalesce(head_day <= last_day, F.lit(True))).over(group)
    order = (
        F.when(F.sum("_known_rows").over(group) < 2, RANDOM)
        .when(up, ASCENDING)
        .when(down, DESCENDING)
        .otherwise(RANDOM)
    )
    wanted = F.sum("_wanted_rows").over(group)
    return (
        carried.withColumns({"_wanted": wanted, "date_order": order})
        .where(F.col("_wanted") > 0)
        .select(source, "_block", "_start", "_carry_last", "_carry_next", "date_order")
    )


def date_order(
    df: DataFrame,
    date: str = DATE,
    source: str = SOURCE_FILE,
    seq: str = SEQ,
    block: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """(source, date_order): day-precision order of the known dates of each file."""
    slim = df.select(source, seq, date, *([block] if block and block != seq else []))
    marked = _within_blocks(slim, date, source, seq, block, rows_per_block)
    return _block_edges(marked, source).groupBy(source).agg(F.max("date_order").alias("date_order"))


def neighbour_dates(
    df: DataFrame,
    date: str = DATE,
    source: str = SOURCE_FILE,
    seq: str = SEQ,
    block: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
    only: str | None = None,
) -> DataFrame:
    """Forward and backward fill: adds prev_valid, next_valid, the distance of both
    in rows (prev_gap, next_gap) and the order of the file (date_order).

    ``only`` names a column; files in which it is never set are left out.
    """
    marked = _within_blocks(df, date, source, seq, block, rows_per_block)
    joined = marked.join(_block_edges(marked, source, only), [source, "_block"])
    here = F.col("_start") + F.col("_row")

    def global_edge(local: str, carried: str, field: str) -> Column:
        if field == "at":
            return F.coalesce(F.col(f"{local}.at"), F.col(f"{carried}.at"))
        return F.coalesce(F.col("_start") + F.col(f"{local}.row"), F.col(f"{carried}.row"))

    return joined.select(
        *df.columns,
        global_edge("_last", "_carry_last", "at").alias("prev_valid"),
        global_edge("_next", "_carry_next", "at").alias("next_valid"),
        (here - global_edge("_last", "_carry_last", "row")).alias("prev_gap"),
        (global_edge("_next", "_carry_next", "row") - here).alias("next_gap"),
        "date_order",
    )


def fill_missing_dates(
    df: DataFrame,
    date: str = DATE,
    source: str = SOURCE_FILE,
    seq: str = SEQ,
    block: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Parse dates, then interpolate or drop the rows without one.

    A missing date survives only between two known dates of the same day in a
    file that is in ascending or descending order; it gets the value on the
    straight line between them, by row position.

    The parsed rows are staged, so that text is read and parsed once.  Rows with a
    date pass straight through: only their key and date go to the neighbour search,
    and a row travels there whole only if its date is missing.  The repaired rows
    are few and staged as well; the result is the union of two scans.
    """
    parsed = stage(standardize_dates(df, date), "parsed")
    keys = list(dict.fromkeys([source, *([block] if block else []), seq]))
    rest = [c for c in df.columns if c not in (*keys, date)]
    missing = F.col(date).isNull()
    slim = parsed.select(
        *keys, date, F.when(missing, F.struct(F.lit(True), *[F.col(f"`{c}`") for c in rest])).alias("_rest")
    )
    near = neighbour_dates(slim, date, source, seq, block, rows_per_block, only="_rest")
    span = F.timestamp_diff("MICROSECOND", F.col("prev_valid"), F.col("next_valid"))
    share = F.expr("cast(_span as decimal(20,0)) * prev_gap div (prev_gap + next_gap)")
    fillable = (
        missing
        & (F.to_date("prev_valid") == F.to_date("next_valid"))
        & (F.col("date_order") != RANDOM)
    )
    filled = (
        near.where(fillable)
        .withColumn("_span", span)
        .withColumn(date, F.timestamp_add("MICROSECOND", share, F.col("prev_valid")))
        .select(
            *[
                F.col("_rest").getField(c).alias(c) if c in rest else F.col(f"`{c}`")
                for c in df.columns
            ]
        )
    )
    return parsed.where(~missing).unionByName(stage(filled, "repaired"))


def forward_fill(
    df: DataFrame, columns: list[str], keys: list[str], order: str
) -> DataFrame:
    """Carry the last known value forward within a series.

    Meant for one row per (keys, day): the window is bounded by the calendar.
    """
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})
