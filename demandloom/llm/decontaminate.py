"""Benchmark decontamination: MinHash containment search, verified by exact containment.

Items and documents are sets of five-word shingles (lower case, words of letters and
digits).  An item is contained if at least ``threshold`` of its shingles are in the
document.  The signature of an item of n shingles is its s smallest shingle hashes with
s = n - ceil(threshold * n) + 1: a document that holds enough of the item lacks at most
s - 1 of its shingles, so at least one of these minima is in it, however long it is, and
no contained item is missed.  Hashes that many items hold come last in the order, so a
phrase they share makes no candidates.  Items are partitioned by size (powers of two).  Each
partition has its own largest signature hash; a document takes part with those of its
hashes that are small enough for a partition, and only with partitions whose smallest
item it is large enough to hold.  The shingles of candidate documents are then joined with those of
the items and counted per document and item, so containment is exact.

Defined results: a null text counts as empty; items of fewer than five words have no
shingle and are contained in nothing; repeated items or documents give one row; a null
``doc_id`` or ``item_id`` is carried through; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.session import stage

SHINGLE = 5
THRESHOLD = 0.8
# A hash that so many items hold is a signature only of items without enough others.
SHARED = 16


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(toks: str, size: int = SHINGLE) -> Column:
    """The distinct shingles of a column of words, words joined by a blank.

    ``toks`` names a column: an expression would be computed again for each shingle.
    """
    last = F.size(toks) - size + 1
    every = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(toks, i, size), " "))
    return F.when(last >= 1, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def hashes(toks: str, size: int = SHINGLE) -> Column:
    """The distinct shingle hashes of a column of words."""
    last = F.size(toks) - size + 1
    every = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(toks, i, size)))
    return F.when(last >= 1, F.array_distinct(every)).otherwise(F.array().cast("array<bigint>"))


def needed(n: Column, threshold: float) -> Column:
    """The fewest shared shingles that reach the threshold (guarded against rounding)."""
    return F.ceil(n * threshold - 1e-9).cast("int")


def item_grams(items: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(item, item_id, n_item, need, gram, h): the distinct shingles of every different item."""
    split = items.select("item_id", tokens(F.coalesce("text", F.lit(""))).alias("toks"))
    split = split.select("item_id", shingles("toks", size).alias("grams")).filter(F.size("grams") > 0)
    once = split.withColumn("item", F.xxhash64("item_id", F.sort_array("grams"))).dropDuplicates(["item"])
    n = F.size("grams")
    return once.select("item", "item_id", n.alias("n_item"), needed(n, threshold).alias("need"), F.explode("grams").alias("gram")).withColumn(
        "h", F.xxhash64(F.split("gram", " "))
    )


def signatures(grams: DataFrame) -> DataFrame:
    """(item, n_item, need, part, minima) from the shingles of the items.

    Any order of all hashes gives whole results.  Here hashes that fewer than ``SHARED`` items hold come
    before those that more hold (by powers of ``SHARED``), so that a phrase many items share is no
    signature of items that have enough else; otherwise the smaller hash comes first, which keeps
    the partitions' limits low.
    """
    held = grams.groupBy("h").agg(F.floor(F.log(float(SHARED), F.count_distinct("item")) + 1e-9).cast("int").alias("common"))
    ranked = grams.join(held, "h").groupBy("item", "n_item", "need").agg(
        F.array_sort(F.collect_set(F.struct("common", "h"))).alias("hashes")
    )
    minima = F.slice("hashes", F.lit(1), F.size("hashes") - F.col("need") + 1)
    return ranked.select(
        "item", "n_item", "need", F.floor(F.log2("n_item")).cast("int").alias("part"),
        F.transform(minima, lambda m: m["h"]).alias("minima"),
    )


def candidates(docs: DataFrame, signed: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, th, item): documents that share a signature hash with an item."""
    # One row per power of two, 31 at most.
    parts = signed.groupBy("part").agg(F.max(F.array_max("minima")).alias("top"), F.min("need").alias("need")).collect()
    split = docs.select("doc_id", F.xxhash64("text").alias("th"), tokens(F.col("text")).alias("toks"))
    base = split.select("doc_id", "th", hashes("toks", size).alias("hashes"))
    n = F.size("hashes")
    # A document's largest useful hash: over the partitions it is large enough for.
    tops = [F.when(n >= p["need"], F.lit(p["top"])) for p in parts]
    top = F.greatest(*tops, F.lit(None).cast("long")) if tops else F.lit(None).cast("long")
    # No filter on a computed column here: it would be pushed below and computed twice.
    small = base.select("doc_id", "th", n.alias("n"), "hashes", top.alias("top"))
    probes = small.select(
        "doc_id", "th", "n", F.explode(F.filter("hashes", lambda h: h <= F.col("top"))).alias("h")
    )
    minima = stage(signed.select("item", "need", F.explode("minima").alias("h")), "signatures")
    return probes.join(minima, "h").filter(F.col("n") >= F.col("need")).select("doc_id", "th", "item").distinct()


def find_contained(
    docs: DataFrame, items: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment, th), one row per contained item."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    grams = stage(item_grams(items, size, threshold), "items")
    found = stage(candidates(texts, stage(signatures(grams), "signed"), size), "candidates")
    wanted = found.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    joined = texts.withColumn("th", F.xxhash64("text")).join(wanted.hint("merge"), F.expr("doc_id <=> __id and th = __th"))
    # Repeated rows are counted apart and become one at the end.
    own = joined.select("doc_id", "th", F.monotonically_increasing_id().alias("row"), tokens(F.col("text")).alias("toks"))
    own = own.select("doc_id", "th", "row", F.explode(shingles("toks", size)).alias("gram"))
    # Counted with map-side combine: no list of a document's items or of an item's shingles.
    counted = own.join(grams, "gram").groupBy("row", "doc_id", "th", "item", "item_id", "n_item", "need").agg(
        F.count(F.lit(1)).alias("n_shared")
    )
    return (
        counted.filter("n_shared >= need")
        .select("doc_id", "item_id", F.col("n_item").cast("long").alias("n_item"), "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"), "th")
        .distinct()
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    found = stage(
        find_contained(docs, items, size, threshold).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct(),
        "contaminated",
    )
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.join(found.hint("merge"), F.expr("doc_id <=> __id and __key = __th"), "left_anti").select(*docs.columns)
