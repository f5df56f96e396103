"""Lookup joins that stay safe when the lookup grows or a key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.session import stage


def lookup_join(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join ``df`` with a lookup that has one row per key.

    The lookup is staged first, so the planner decides from its measured size:
    below ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and ``df`` is
    not shuffled at all, above it both sides are sort-merged and adaptive
    execution splits the partitions of hot keys.
    """
    return df.join(stage(lookup, "lookup"), on, how)


def keep_listed(df: DataFrame, column: str, allowed: list[str] | DataFrame) -> DataFrame:
    """Rows whose ``column`` is in a list or in the same-named column of a table."""
    if isinstance(allowed, DataFrame):
        return lookup_join(df, allowed.select(column).distinct(), [column], "left_semi")
    return df.where(F.col(column).isin(allowed))


def drop_listed(df: DataFrame, column: str, banned: DataFrame) -> DataFrame:
    """Rows whose ``column`` is known and not in ``banned``.

    An anti join alone would keep rows with a null key.
    """
    known = df.where(F.col(column).isNotNull())
    return lookup_join(known, banned.select(column).distinct(), [column], "left_anti")
