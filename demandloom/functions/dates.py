"""Date parsing and calendar expressions.

Every accepted spelling is rearranged into ISO order with ``regexp_replace``
and then ``try_cast`` to ``timestamp_ntz``.  That stays in generated code, does
not depend on the session time zone, and yields null for impossible dates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date spellings in order of precedence, each with the
# rearrangement that turns it into ISO order.  The first pattern that matches decides.
DATE_SPELLINGS = [
    (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?)\z", "$1"),  # 2019-01-03 08:46:08.000
    (r"^(\d{4}-\d{2}-\d{2})\z", "$1"),  # 2019-01-03
    (r"^(\d{2})-(\d{2})-(\d{4})\z", "$3-$1-$2"),  # 01-03-2019, month first
    (r"^(\d{2})/(\d{2})/(\d{4})\z", "$3-$2-$1"),  # 03/01/2019, day first
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})\z", "$3-$1-$2"),  # 3/1/2019, month first
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})\z", "$3-$1-$2"),  # 3-1-2019, month first
]


def parse_mixed_date(text: Column) -> Column:
    """Timestamp for any accepted spelling, null otherwise."""
    iso = F.lit(None).cast("string")
    for pattern, layout in reversed(DATE_SPELLINGS):
        iso = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, layout)).otherwise(iso)
    return iso.try_cast("timestamp_ntz")


def has_date_shape(text: Column) -> Column:
    """True when separators sit where a supported date text has them."""

    def separators(mark: str, first: int, second: int) -> Column:
        return (F.substring(text, first, 1) == mark) & (F.substring(text, second, 1) == mark)

    return (F.length(text) >= 10) & (
        separators("-", 5, 8) | separators("-", 3, 6) | separators("/", 3, 6)
    )


def iso_weekday(col: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(col) + 1


def is_weekend(col: Column) -> Column:
    return F.weekday(col) >= 5


def week_parts(col: Column) -> dict[str, Column]:
    """Calendar year, month and ISO week (the year stays the calendar year)."""
    return {"Year": F.year(col), "Month": F.month(col), "Week_of_year": F.weekofyear(col)}


def calendar_parts(col: Column) -> dict[str, Column]:
    return {
        "day_of_week": iso_weekday(col),
        "is_weekend": is_weekend(col).cast("tinyint"),
        "day_of_month": F.dayofmonth(col),
        "day_of_year": F.dayofyear(col),
        "month": F.month(col),
        "week_of_year": F.weekofyear(col),
    }
