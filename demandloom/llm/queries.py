"""One query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.llm import (
    byte_bpe,
    centroids,
    classifier,
    decontaminate,
    line_dedup,
    pii,
    quality_rules,
    runs,
    sentencepiece,
    simhash,
    substring_dedup,
    toxicity,
    warc,
)
from demandloom.llm.common import table


def op1_line_dedup(spark, sf_dir):
    return line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"), counts=True).select(
        "doc_id", "n_lines", "n_removed", "text"
    )


def op2_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return classifier.score_texts(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))


def op3_sentencepiece(spark, sf_dir):
    done = sentencepiece.decode(sentencepiece.encode(table(spark, sf_dir, "documents")))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


def op4_decontaminate(spark, sf_dir):
    found = decontaminate.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op5_substring_dedup(spark, sf_dir):
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op7_warc(spark, sf_dir):
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark, sf_dir):
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark, sf_dir):
    return runs.digests(runs.report(runs.with_repeats(table(spark, sf_dir, "documents"))))


def op12_centroids(spark, sf_dir):
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark, sf_dir):
    done = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), packed=True))
    return done.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontaminate": op4_decontaminate,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_pii": op6_pii,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_simhash": op9_simhash,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroids": op12_centroids,
    "op13_byte_bpe": op13_byte_bpe,
}
