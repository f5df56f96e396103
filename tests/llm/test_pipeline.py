"""The pipeline as a whole, and its queries against SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from demandloom.llm import classifier, decontaminate, sentencepiece, simhash
from demandloom.llm.sql import SQL
from tools.check_queries import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


def test_stages(spark, sample_docs, tmp_path):
    docs = sample_docs
    labels, items = spark.read.parquet(f"{SF_DIR}/labels.parquet"), spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.schema == sample_docs.schema, name
        ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if k == 0:
            rows = classifier.score_texts(before, classifier.fit(before, labels)).collect()
            assert ids == sorted(r.doc_id for r in rows if r.predicted)
        elif k == 1:
            assert docs.count() == before.count()
        elif k == 2:
            assert ids == sorted({r.component_id for r in simhash.near_duplicates(before).collect()})
        elif k == 3:
            gone = {r.doc_id for r in decontaminate.find_contained(before, items).collect()}
            assert ids == sorted(r.doc_id for r in before.collect() if r.doc_id not in gone) and gone
    assert docs.columns == ["doc_id", "n_pieces", "ids", "decoded_sha256"] and docs.count() == before.count()
    table = sentencepiece.Pieces()
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(table.decode(r.ids) == texts[r.doc_id] for r in docs.collect())


def test_run_is_registered(spark):
    assert spark_entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    df = spark_entry.queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, cursor.fetchall())
