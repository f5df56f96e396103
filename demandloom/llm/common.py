"""Shared pieces of the corpus operators: words, row keys, batches, graph components."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.session import stage

#: The white space that separates words, as regular expression class content.
WHITE = r"\x20\x09-\x0D"
#: The same six characters, for translate().
WHITE_CHARS = " \t\n\x0b\x0c\r"

#: Rows and bytes of one Arrow batch; a batch of very long texts stays small.
BATCH_ROWS = "500"
BATCH_BYTES = str(8 << 20)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that bound the memory of Python workers and split hot join keys.

    Functions of this package travel to Python workers by value, so executors need not have it.
    """
    cloudpickle.register_pickle_by_value(sys.modules["demandloom.llm"])
    for key, value in {
        "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
        "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), without any other column that may clash."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", *more, F.coalesce("text", F.lit("")).alias("text"))


def words(text: Column) -> Column:
    """The words of a text: maximal runs of anything but the six white-space characters."""
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")


def map_texts(
    docs: DataFrame, rows_of: Callable[[object, str], Iterator[tuple]], schema: pa.Schema
) -> DataFrame:
    """``rows_of(doc_id, text)`` for every document, in Arrow batches.

    Output leaves in batches of bounded size, so one text with very many rows is fine.
    """

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in rows_of(doc_id, text or ""):
                    out.append(row)
                    if len(out) >= 20_000:
                        yield to_batch(out, schema)
                        out = []
            if out:
                yield to_batch(out, schema)

    return docs.select("doc_id", "text").mapInArrow(run, spark_schema(schema))


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def spark_schema(schema: pa.Schema):
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links of long ids: (node, root), root the smallest node.

    Alternating large-star and small-star steps.  Each step is an aggregation and a join
    on the node, written to the shared folder, so nothing is held by one task or the
    driver and hot nodes are split as skewed join keys.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
        "links",
    )
    before = _fingerprint(edges)
    while True:
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        large = stage(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        edges = stage(small, "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())
