"""SimHash near-duplicates: majority fingerprints linked through covering hash tables.

Two fingerprints are linked if they differ in at most ``radius`` bits.  Every bit of the
64 gets a non-zero vector of ``radius + 1`` bits; mask ``v`` keeps the bits whose vector
has an odd product with ``v``.  The vectors of up to ``radius`` differing bits span at
most ``radius`` dimensions, so some ``v`` is orthogonal to all of them: under that mask
the two fingerprints are equal.  The ``2^(radius+1) - 1`` tables thus miss no pair.

Defined results: a null text counts as empty; a text without words has fingerprint zero
and is linked like any other; a null ``doc_id`` is kept but never the smallest id of a
component that has another one; repeated rows share one fingerprint; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import components, map_texts, text_of
from demandloom.session import stage

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
#: Up to so many fingerprints of one bucket are compared pair by pair; larger buckets go
#: through shared neighbour values, which finds the same links with linear output.
PAIR_LIMIT = 256
#: Shingles that are turned into bits at a time.
CHUNK = 1 << 15

FINGERPRINT = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint(text: str, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit majority fingerprint of a text, unsigned."""
    parts = text.encode().lower().split()  # bytes: A-Z and the six white-space characters only
    if not parts:
        return 0
    total = max(len(parts) - size + 1, 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, total, CHUNK):
        ends = [parts[start + i : start + i + CHUNK + size - 1] for i in range(min(size, len(parts)))]
        grams = [b" ".join(g) for g in zip(*ends)][:CHUNK]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64, len(grams))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row; ``fp`` is the fingerprint as a signed long."""

    def rows(doc_id, text):
        value = fingerprint(text)
        yield doc_id, value - (1 << 64) if value >> 63 else value

    return map_texts(text_of(docs), rows, FINGERPRINT)


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks as signed longs."""
    vectors = [1 + bit % ((1 << (radius + 1)) - 1) for bit in range(64)]
    out = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << bit for bit in range(64) if (vectors[bit] & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``radius`` bits.

    ``distinct`` has one row per fingerprint, so exact copies never meet here.
    """
    table = masks(radius)
    keyed = distinct.select("fp", F.posexplode(F.array([F.lit(m) for m in table])).alias("mask", "m")).select(
        "mask", F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp"
    )
    shared = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = stage(keyed.join(shared, ["mask", "key"]), "buckets")
    small = members.filter(F.col("n") <= pair_limit)
    left, right = small.select("mask", "key", F.col("fp").alias("a")), small.select("mask", "key", F.col("fp").alias("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    pairs = (
        left.alias("l")
        .join(right.alias("r"), (F.col("l.mask") == F.col("r.mask")) & (F.col("l.key") == F.col("r.key")) & near)
        .select("a", "b")
        .distinct()
    )
    return pairs.union(_neighbour_links(members.filter(F.col("n") > pair_limit), radius, table))


def _neighbour_links(members: DataFrame, radius: int, table: list[int]) -> DataFrame:
    """Links inside large buckets through values near both ends.

    Two fingerprints at distance d <= radius share a value at distance <= radius // 2 of
    one and <= radius - radius // 2 of the other, and it differs only in bits outside the
    mask.  All fingerprints around a value are linked to the smallest one of the inner
    distance.  A value has at most a few hundred fingerprints around it.
    """
    inner, outer = radius // 2, radius - radius // 2

    def run(batches):
        from itertools import combinations

        free = [[b for b in range(64) if not (m >> b) & 1] for m in table]
        flips = [
            [np.array([sum(1 << b for b in c) for c in combinations(bits, d)], dtype=np.uint64) for d in range(outer + 1)]
            for bits in free
        ]
        schema = pa.schema([("mask", pa.int32()), ("z", pa.int64()), ("fp", pa.int64()), ("near", pa.bool_())])
        for batch in batches:
            for mask, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = np.uint64(fp & ((1 << 64) - 1))
                for d, flip in enumerate(flips[mask]):
                    z = (value ^ flip).view(np.int64)
                    n = len(z)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, mask, np.int32)), pa.array(z), pa.array(np.full(n, fp, np.int64)), pa.array(np.full(n, d <= inner))],
                        schema=schema,
                    )

    around = members.select("mask", "fp").mapInArrow(run, "mask int, z long, fp long, near boolean")
    return (
        around.groupBy("mask", "z")
        .agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"), F.collect_set("fp").alias("all"))
        .filter(F.col("a").isNotNull() & (F.size("all") > 1))
        .select("a", F.explode("all").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document."""
    found, _ = _classes(stage(fingerprints(docs), "fingerprints"), radius, pair_limit)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(prints: DataFrame, radius: int, pair_limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their component's smallest id, and (fp, root) of every fingerprint."""
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-prints")
    linked = stage(components(fingerprint_links(distinct, radius, pair_limit)), "print-components")
    rooted = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage(rooted, "rooted-prints")
    # Only components of several fingerprints need a minimum across fingerprints.
    ids = (
        rooted.join(linked.select(F.col("root")).distinct(), "root", "left_semi")
        .groupBy("root").agg(F.min("first").alias("id"))
    )
    labels = rooted.join(ids, "root", "left").select(
        "fp", "root", F.coalesce("id", "first").alias("component_id")
    )
    labels = stage(labels, "print-labels")
    return prints.join(labels, "fp"), labels.select("fp", "root")


def keep_one(docs: DataFrame, radius: int = RADIUS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest ``doc_id``.

    Documents without an id come after all others; on a tie the smaller fingerprint and
    text hash stay, and of rows alike in id and text any one stays.
    """
    keyed = docs.withColumn("__text", F.xxhash64(F.coalesce("text", F.lit(""))))
    prints = stage(
        map_texts_with_hash(docs), "fingerprints"
    )
    found, roots = _classes(prints, radius, pair_limit)
    rank = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "fp", "hash")
    best = (
        found.select("doc_id", "hash", "fp").join(roots, "fp")
        .groupBy("root").agg(F.min(rank).alias("best"))
        .select("best.doc_id", "best.hash")
    )
    copies = prints.groupBy("doc_id", "hash").agg(F.count("*").alias("copies"))
    best = stage(
        best.alias("x").join(copies.alias("y"), F.expr("x.doc_id <=> y.doc_id and x.hash = y.hash"))
        .select(F.col("x.doc_id").alias("__id"), F.col("x.hash").alias("__hash"), F.col("copies").alias("__copies")),
        "survivors",
    )
    kept = keyed.join(best.hint("merge"), F.expr("doc_id <=> __id and __text = __hash"))
    once = kept.filter("__copies = 1").select(*docs.columns)
    again = kept.filter("__copies > 1").dropDuplicates(["doc_id", "__text"]).select(*docs.columns)
    return once.union(again)


def map_texts_with_hash(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, hash) per row; ``hash`` tells apart texts under one id."""
    hashed = text_of(docs).select("doc_id", "text", F.xxhash64("text").alias("hash"))

    def run(batches):
        for batch in batches:
            values = [fingerprint(t or "") for t in batch.column(1).to_pylist()]
            prints = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), prints, batch.column(2)], names=["doc_id", "fp", "hash"])

    return hashed.mapInArrow(run, "doc_id long, fp long, hash long")
