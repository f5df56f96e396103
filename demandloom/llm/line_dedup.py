"""Line de-duplication: overlapping windows of three lines that occurred before are removed.

Lines are the pieces between line feeds; blank ones (white space only) take no part in
windows.  Three consecutive lines are one window, known by two 64-bit hashes.  Of the
occurrences of a window the first one by (doc_id, text hash, position) stays, every later
one covers its lines, the blank ones between them included; covered lines are removed.
A line that goes is always still present at the first place of its window.

Counting windows combines on the map side, so a passage found in a third of all documents
is one row per task; joining it back is a join Spark can split.

Defined results: a null text stays null and has no lines; a text of fewer than three lines
has no window and stays; null ids come after all others; rows alike in id and text are one
document and get the same result; an empty table gives an empty result; all other columns
pass through (``n_chars`` is the new length, if there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import WHITE_CHARS
from demandloom.session import stage

LINES = 3


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, th, k1, k2, start, end): every window, ``start`` and ``end`` line numbers."""
    split = docs.filter("text is not null").select(
        "doc_id",
        F.xxhash64("text").alias("th"),
        F.filter(
            F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("i"))),
            lambda s: F.translate(s["line"], WHITE_CHARS, "") != "",
        ).alias("lines"),
    )
    hashed = split.select(
        "doc_id", "th",
        F.transform("lines", lambda s: F.struct(F.xxhash64(s["line"]).alias("a"), F.xxhash64(F.lit(lines), s["line"]).alias("b"), s["i"].alias("i"))).alias("lines"),
    )
    at = lambda i, d: F.get("lines", i + d)
    window = lambda i: F.struct(
        F.xxhash64(*[at(i, d)["a"] for d in range(lines)]).alias("k1"),
        F.xxhash64(F.lit(1), *[at(i, d)["b"] for d in range(lines)]).alias("k2"),
        at(i, 0)["i"].alias("start"),
        at(i, lines - 1)["i"].alias("end"),
    )
    # A filter on the computed size would be pushed below and split every text twice.
    last = F.size("lines") - lines
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    every = hashed.select("doc_id", "th", F.explode(F.transform(starts, window)).alias("w"))
    return every.select("doc_id", "th", "w.*")


def later_windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, th, start, end) of the windows that occurred before."""
    found = windows(docs, lines)
    place = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "th", "start")
    # Written, so that the join below has two plain sides and a hot window can be split.
    first = stage(
        found.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("k1", "k2", "first"),
        "repeated-windows",
    )
    later = found.join(first, ["k1", "k2"]).filter(place != F.col("first"))
    return later.select("doc_id", "th", "start", "end")


def remove_repeated_lines(docs: DataFrame, lines: int = LINES, counts: bool = False) -> DataFrame:
    """``docs`` without the covered lines; ``counts`` adds ``n_lines`` and ``n_removed``."""
    cover = stage(
        later_windows(docs, lines)
        # A document's windows are as many as its lines.
        .groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cover"))
        .select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("cover").alias("__cover")),
        "covered-lines",
    )
    names = [c for c in docs.columns if c not in ("text", "n_chars")]
    # A merge join at every size: texts move once, whatever the number of repeats.
    joined = docs.withColumn("__key", F.xxhash64("text")).join(cover.hint("merge"), F.expr("doc_id <=> __id and __key = __th"), "left")
    split = joined.withColumn("__lines", F.split("text", "\n"))
    before = lambda k: F.coalesce(F.get("__cover", k - 1)["end"], F.lit(-1))
    kept = F.concat(
        F.flatten(
            F.transform("__cover", lambda w, k: F.slice("__lines", before(k) + 2, F.greatest(F.lit(0), w["start"] - before(k) - 1)))
        ),
        F.slice("__lines", F.element_at("__cover", -1)["end"] + 2, F.size("__lines")),
    )
    done = split.withColumn("__kept", F.when(F.col("__cover").isNotNull(), kept))
    out = {name: F.col(f"`{name}`") for name in names}
    text = F.when(F.col("__kept").isNotNull(), F.array_join("__kept", "\n")).otherwise(F.col("text"))
    done = done.withColumn("__text", text)
    out["text"] = F.col("__text")
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("__kept").isNotNull(), F.length("__text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    columns = [out[name].alias(name) for name in docs.columns]
    if counts:
        n = F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines"))
        columns += [n.cast("long").alias("n_lines"), F.when(F.col("__kept").isNotNull(), n - F.size("__kept")).otherwise(0).cast("long").alias("n_removed")]
    return done.select(*columns)
