"""Containment search against comparing every document with every item."""

from __future__ import annotations

import re

from demandloom.llm import decontaminate


def grams(text, size=5):
    parts = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {" ".join(parts[i : i + size]) for i in range(len(parts) - size + 1)}


def plain(docs, items, threshold=0.8):
    out = set()
    for i, t in docs:
        have = grams(t)
        for j, u in items:
            want = grams(u)
            if want and len(want & have) >= threshold * len(want) - 1e-9:
                out.add((i, j, len(want), len(want & have)))
    return out


def check(docs, items):
    pairs = lambda df, c: [(r[c], r.text) for r in df.collect()]
    got = [(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in decontaminate.find_contained(docs, items).collect()]
    want = plain(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert sorted(set(got), key=repr) == sorted(want, key=repr)
    return want


def test_threshold_and_long_documents(spark, make_docs):
    item = [f"q{i}" for i in range(24)]  # 20 shingles, 16 needed
    filler = " ".join(f"f{i}" for i in range(5000))
    cut = lambda k: " ".join(item[:k])
    docs = make_docs([(k, f"{filler} {cut(k)}") for k in range(18, 25)] + [(90, f"{cut(24).upper()}!"), (91, None), (92, " ".join(item[:12] + ["x"] + item[12:]))])
    items = spark.createDataFrame([(1, cut(24), 0), (2, "too short here", 0), (3, None, 0), (4, cut(5), 0), (None, "a b c d e f", 0), (1, cut(24), 0)], "item_id long, text string, h int")
    want = check(docs, items)
    assert {i for i, j, *_ in want if j == 1} == {20, 21, 22, 23, 24, 90, 92}


def test_edge_cases(spark, edge_docs):
    items = spark.createDataFrame([(7, "one two three four five six seven alpha beta")], "item_id long, text string")
    assert {i for i, *_ in check(edge_docs, items)} == {None, 2, 5}
    kept = decontaminate.remove_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted((str(r.doc_id), str(r.text)[:5]) for r in kept.collect()) == sorted(
        [("None", "None"), ("1", ""), ("3", "w0x0 "), ("3", "short"), ("4", " \n\t "), ("6", "é ß 日")]
    )
    assert decontaminate.find_contained(edge_docs.limit(0), items).count() == 0
    assert decontaminate.find_contained(edge_docs, items.limit(0)).count() == 0


def test_sample(spark, sample_docs):
    check(sample_docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


def test_phrase_that_many_items_share(spark, make_docs):
    phrase = "which of the following statements best describes"
    own = lambda k: " ".join(f"i{k}w{j}" for j in range(20))
    rows = [(k, f"{phrase} {own(k)}", 0) for k in range(60)]
    items = spark.createDataFrame(rows, "item_id long, text string, h int")
    docs = make_docs([(k, f"d{k} a {phrase} b{k} c") for k in range(80)] + [(100, f"x {phrase} {own(7)} y")] * 2)
    signed = decontaminate.signatures(decontaminate.item_grams(items))
    pairs = decontaminate.candidates(docs.select("doc_id", "text"), signed)
    assert [(r.doc_id) for r in pairs.collect()] == [100]
    assert {i[:2] for i in check(docs, items)} == {(100, 7)}


def test_items_made_of_shared_phrases_only(spark, make_docs):
    words = "one two three four five six seven eight".split()
    texts = [" ".join(words[a:b]) for a in range(4) for b in range(a + 5, 9)]
    items = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "item_id long, text string, h int")
    docs = make_docs([(1, " ".join(words)), (2, "one two three four five"), (3, "two three four five six seven x eight")])
    assert len(check(docs, items)) > len(texts)
