"""First-row-wins de-duplication."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.schema import TX_ID
from demandloom.session import stage


def first_per_key(
    df: DataFrame,
    key: str = TX_ID,
    order: list[str] | None = None,
    per: list[str] | None = None,
) -> DataFrame:
    """Keep the first row of every key in the given order, within each ``per`` group.

    Few keys repeat, so only keys are counted and shuffled first.  Rows of keys that stand
    once pass an anti join with the written list of repeated keys and stay where they are
    while that list is small.  Rows of repeated keys go through the minimum of a struct led
    by the order columns, an aggregate with map-side combine: each task forwards one row
    per key, so a key that holds a large share of all rows costs no more than any other.
    Without ``order`` all columns decide, which makes the result independent of row order.
    """
    keys = [*(per or []), key]
    lead = [c for c in (order or df.columns) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    named = [F.col(f"`{k}`") for k in keys]
    counted = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    repeated = stage(counted.select(*[c.alias(f"_key{i}") for i, c in enumerate(named)]), "repeated-keys")
    same = reduce(and_, [c.eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(named)])
    winner = F.min(F.struct(*[F.col(f"`{c}`") for c in [*lead, *rest]])).alias("_first")
    first = df.join(repeated, same, "left_semi").groupBy(*named).agg(winner).select(
        *[F.col(f"`{c}`") if c in keys else F.col("_first").getField(c).alias(c) for c in df.columns]
    )
    return df.join(repeated, same, "left_anti").unionByName(first)


def duplicate_count(df: DataFrame, key: str = TX_ID) -> DataFrame:
    """One row: rows seen and rows beyond the first of each key."""
    per_key = df.groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_seen"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_removed"),
    )
