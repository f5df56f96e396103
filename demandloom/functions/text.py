"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_name(col: Column) -> Column:
    """Strip any whitespace at both ends, then lower-case; null stays null."""
    return F.lower(F.regexp_replace(col.cast("string"), r"^\s+|\s+$", ""))


def file_stem(name: Column) -> Column:
    """``a/b/Some File.csv`` -> ``Some_File``."""
    base = F.regexp_extract(name, r"([^/]+?)(\.[^./]*)?$", 1)
    return F.replace(base, F.lit(" "), F.lit("_"))


def processed_name(name: Column) -> Column:
    """Fixed output name for an input file."""
    return F.concat(F.lit("processed_"), file_stem(name), F.lit(".csv"))


def number_or_null(col: Column) -> Column:
    """Numeric value of a text, null when it is not a number.

    The cast alone would also take a Java type suffix, as in ``5d``.
    """
    text = col.cast("string")
    value = F.when(~text.rlike(r"[0-9.]\s*[dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(value), value)
