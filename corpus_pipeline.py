"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

1. quality classifier: documents scored below 0.5 go;
2. line dedup: later occurrences of three-line windows go from the texts;
3. SimHash near-dedup: one document of each group stays;
4. benchmark decontamination: documents that contain a test item go;
5. SentencePiece: texts become piece ids; they are decoded, which gives the input back
   exactly, and the hash of the decoded text comes with them.

All stages but the last return the columns of ``documents``.

Defined results: a null or empty text is scored like any other text; if kept, it has no lines, links
to other empty texts in SimHash, contains no item and has no pieces.  Repeated rows are scored and
cleaned alike; of rows with equal ids SimHash keeps what ``simhash.keep_one`` states.  Columns
other than those of the operators are carried along, whatever their names.  An empty table
gives an empty result.  Without labels every score is the same.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandloom.llm import classifier, decontaminate, line_dedup, sentencepiece, simhash  # noqa: E402
from demandloom.llm.common import prepare, table  # noqa: E402
from demandloom.session import remove_path, scratch_path, staged_scope  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = sentencepiece.decode(sentencepiece.encode(docs))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding and decoding", pieces),
]

#: SQL can't express the trained classifier; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES, 1):
        path = scratch_path(prepare(spark), f"pipeline-{k}")
        # What a stage has staged, and its input, are not needed once its result is written.
        with staged_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
