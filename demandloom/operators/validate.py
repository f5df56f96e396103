"""Schema checks, row rules and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.dates import has_date_shape
from demandloom.functions.text import number_or_null
from demandloom.schema import DAILY_COLUMNS, DATE, PRODUCT, RAW_COLUMNS, SOURCE_FILE, TOTAL, TYPED
from demandloom.sources.records import ends_inside

# Messages of the checks.
EMPTY_MESSAGE = "DataFrame is empty, no rows found"
MISSING_MESSAGE = "Missing columns: "
PRODUCT_MESSAGE = "Product Name must be a string"
NUMERIC_MESSAGE = "Total Quantity must be numeric"
POSITIVE_MESSAGE = "Total Quantity must be greater than 0"
NULL_DATE_MESSAGE = "Date cannot be null"
DATE_SHAPE_MESSAGE = "Date must be in a valid date format"
BAD_VALUE_MESSAGE = "Bad value in "
OPEN_QUOTE_MESSAGE = "The file ends inside a quoted field"
DOCUMENT_MESSAGE = "The file is not a complete JSON document"
# A comma with an even number of quotes behind it.
OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
ALL_VALID, SOME_VALID, NONE_VALID = 0, 1, 2


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required names the table lacks, in required order."""
    return [c for c in required if c not in df.columns]


def check_columns(
    df: DataFrame, required: list[str] = RAW_COLUMNS
) -> tuple[bool, str | None]:
    """(valid, message): rows must exist and every required column be present."""
    if df.isEmpty():
        return False, EMPTY_MESSAGE
    absent = missing_columns(df, required)
    return (False, MISSING_MESSAGE + ", ".join(absent)) if absent else (True, None)


def mark_missing(df: DataFrame, absent: list[str]) -> DataFrame:
    """Every row gets the same single reason; nothing is marked without a missing column."""
    reasons = [F.lit(MISSING_MESSAGE + ", ".join(absent))] if absent else []
    return df.withColumn("reasons", F.array(*reasons).cast("array<string>"))


def _collect(*rules: tuple[Column, str]) -> Column:
    return F.filter(
        F.array(*[F.when(broken, F.lit(message)) for broken, message in rules]),
        lambda reason: reason.isNotNull(),
    )


def row_reasons(text_product: bool = True) -> Column:
    """Reasons a daily row is invalid; empty when it is fine.

    A product column of another type than text makes every row invalid.
    """
    quantity = number_or_null(F.col(TOTAL))
    date = F.col(DATE).cast("string")
    return _collect(
        (F.col(PRODUCT).isNull() | F.lit(not text_product), PRODUCT_MESSAGE),
        (quantity.isNull(), NUMERIC_MESSAGE),
        (quantity <= 0, POSITIVE_MESSAGE),
        (date.isNull(), NULL_DATE_MESSAGE),
        (~has_date_shape(date), DATE_SHAPE_MESSAGE),
    )


def check_rows(df: DataFrame) -> DataFrame:
    """Adds ``reasons``: the row rules, or the missing columns if there are any."""
    absent = missing_columns(df, DAILY_COLUMNS)
    if absent:
        return mark_missing(df, absent)
    return df.withColumn("reasons", row_reasons(isinstance(df.schema[PRODUCT].dataType, T.StringType)))


def failing_rows(df: DataFrame) -> DataFrame:
    """Invalid rows with all their reasons joined in ``anomaly_reason``."""
    return (
        check_rows(df)
        .where(F.size("reasons") > 0)
        .withColumn("anomaly_reason", F.concat_ws("; ", "reasons"))
        .drop("reasons")
    )


def validation_summary(df: DataFrame) -> DataFrame:
    """One row: results, has_errors, missing_columns, error_count.

    An empty table lists its message in ``results`` yet counts as free of errors,
    unless columns are missing.
    """
    absent = missing_columns(df, DAILY_COLUMNS)
    names = F.array(*[F.lit(c) for c in absent]).cast("array<string>")
    no_messages = F.array().cast("array<string>")
    counted = check_rows(df).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("reasons") > 0).alias("error_count"),
    )
    return counted.select(
        F.when(F.col("rows") == 0, F.array(F.lit(EMPTY_MESSAGE)))
        .otherwise(no_messages)
        .alias("results"),
        ((F.col("error_count") > 0) | F.lit(bool(absent))).alias("has_errors"),
        names.alias("missing_columns"),
        "error_count",
    )


def file_verdicts(lines: DataFrame, files: DataFrame, required: list[str] = RAW_COLUMNS) -> DataFrame:
    """Verdict per delimited file from its header and its number of records.

    ``lines`` has (file_path, block_start, line_no, value), lines or whole records (then with
    ``open``); ``files`` lists every file, so that one without any line is judged too.  A
    task forwards one header candidate and one count per file, whatever its size.

    ``breaks`` says that a line ends inside quotes: lines are then not the records, and the
    file is to be judged by those (``records.assemble``).  ``first`` is the header's place.
    """
    full = F.trim("value") != ""
    place = F.when(full, F.struct("block_start", "line_no"))
    whole = "open" in lines.columns
    found = lines.groupBy("file_path").agg(
        F.min_by("value", place).alias("header"),
        F.min(place).alias("first"),
        (F.count_if(full) - 1).alias("rows"),
        (F.lit(True) if whole else F.bool_or(ends_inside(F.col("value")))).alias("breaks"),
        (F.bool_or("open") if whole else F.lit(False)).alias("open"),
    )
    fields = F.transform(
        F.split("header", OUTSIDE_QUOTES), lambda name: F.regexp_replace(name, r'^[\s"\x{FEFF}]+|[\s"]+$', "")
    )
    absent = F.array_except(F.array(*[F.lit(c) for c in required]), fields)
    judged = files.select("file_path").join(found, "file_path", "left")
    error = (
        F.when(F.col("open"), F.lit(OPEN_QUOTE_MESSAGE))
        .when(F.coalesce(F.col("rows"), F.lit(0)) <= 0, F.lit(EMPTY_MESSAGE))
        .when(F.size(absent) > 0, F.concat(F.lit(MISSING_MESSAGE), F.concat_ws(", ", absent)))
    )
    return judged.select(
        "file_path",
        "header",
        "first",
        F.coalesce("breaks", F.lit(False)).alias("breaks"),
        F.greatest(F.coalesce("rows", F.lit(0)), F.lit(0)).alias("rows"),
        error.alias("error"),
    ).withColumn("valid", F.col("error").isNull())


def document_verdicts(found: DataFrame, files: DataFrame, required: list[str] = RAW_COLUMNS) -> DataFrame:
    """Verdict per JSON document, in the columns of ``file_verdicts``; a document has no header.

    ``found`` has (file_path, rows, has, broken) as ``documents.document_rows`` gives it.
    """
    judged = files.select("file_path").join(found, "file_path", "left")
    absent = F.array_except(F.array(*[F.lit(c) for c in required]), "has")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    error = (
        F.when(F.col("broken"), F.lit(DOCUMENT_MESSAGE))
        .when(rows <= 0, F.lit(EMPTY_MESSAGE))
        .when(F.size(absent) > 0, F.concat(F.lit(MISSING_MESSAGE), F.concat_ws(", ", absent)))
    )
    return judged.select(
        "file_path",
        F.lit(None).cast("string").alias("header"),
        F.lit(None).cast("struct<block_start:bigint,line_no:bigint>").alias("first"),
        F.lit(False).alias("breaks"),
        rows.alias("rows"),
        error.alias("error"),
    ).withColumn("valid", F.col("error").isNull())


def bad_values(raw: DataFrame, per: str = SOURCE_FILE) -> DataFrame:
    """(file_path, bad): columns of a file that hold a text no number can be read from.

    ``raw`` has text columns; files without such a cell are left out.
    """
    checks = []
    for field in TYPED.fields:
        if field.name in raw.columns and isinstance(field.dataType, T.NumericType):
            text = F.col(f"`{field.name}`")
            checks.append(F.when(F.bool_or(text.isNotNull() & text.try_cast("double").isNull()), F.lit(field.name)))
    found = raw.groupBy(F.col(per).alias("file_path")).agg(F.concat_ws(", ", *checks).alias("bad"))
    return found.where("bad <> ''")


def add_bad_values(verdicts: DataFrame, bad: DataFrame) -> DataFrame:
    """Verdicts in which files with bad values are invalid too."""
    joined = verdicts.join(bad, "file_path", "left")
    error = F.when(F.col("bad").isNotNull(), F.concat(F.lit(BAD_VALUE_MESSAGE), F.col("bad"))).otherwise(F.col("error"))
    return joined.withColumn("error", error).withColumn("valid", F.col("error").isNull()).select(*verdicts.columns)


def batch_status(verdicts: DataFrame) -> DataFrame:
    """One row: files, valid files and the status 0 (all), 1 (some) or 2 (none valid)."""
    return verdicts.agg(
        F.count(F.lit(1)).alias("files"), F.count_if("valid").alias("valid_files")
    ).withColumn(
        "status",
        F.when((F.col("files") > 0) & (F.col("files") == F.col("valid_files")), ALL_VALID)
        .when(F.col("valid_files") > 0, SOME_VALID)
        .otherwise(NONE_VALID),
    )


def batch_report(verdicts: DataFrame) -> DataFrame:
    """The report as lines in reading order (section, file_path, line): failed files
    first, then passed ones.  Order by (section, file_path) when writing."""
    return verdicts.select(
        F.when(F.col("valid"), 2).otherwise(1).alias("section"),
        "file_path",
        F.when(F.col("valid"), F.col("file_path"))
        .otherwise(F.concat_ws(": ", "file_path", "error"))
        .alias("line"),
    )
