"""Ids against the public library, byte for byte, and round trips."""

from __future__ import annotations

import hashlib
import os
import random

import numpy as np
import pytest

from demandloom.llm import byte_bpe, queries
from tests.llm.conftest import LONG, SF_DIR

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    if not os.path.exists(byte_bpe.VOCABULARY):
        pytest.skip("the vocabulary file is absent")
    return byte_bpe.read_ranks()


@pytest.fixture(scope="module")
def encoder(ranks):
    return byte_bpe.Encoder(ranks).open()


@pytest.fixture(scope="module")
def library(ranks):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array(own.encode_ordinary(text), "<u4").tobytes()


def test_perfect_hash_is_minimal(ranks, encoder):
    table = encoder.table
    assert len(table.keys) == len(ranks) and None not in table.keys
    assert all(table.find(token) == rank for token, rank in ranks.items())
    assert table.find(b"no such token, surely") == -1
    assert byte_bpe.PerfectHash({}).find(b"x") == -1


def test_random_texts(encoder, library):
    rng = random.Random(1)
    alphabet = "aabthe 'sSt  \n\t\r\x0b\x1c\x85\xa0é日本語🤖՘֋ 123٣½　_-.\U00010940\U00011de0ЖжمÀ́"
    for _ in range(5000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert encoder.encode(text) == library(text), text


def test_every_kind_of_character(encoder, library):
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (code < 0x3000 or code % 61 == 0):
            text = f"a{chr(code)}1 {chr(code)}"
            assert encoder.encode(text) == library(text), hex(code)


def test_long_pretokens_and_slices(encoder, library, monkeypatch):
    rng = random.Random(2)
    for text in ("a" * 50_000, "".join(rng.choice("abcdefgh") for _ in range(20_000)), "é" * 5000, LONG):
        assert encoder.encode(text) == library(text)
    monkeypatch.setattr(byte_bpe, "SLICE", 7)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    text = "one  two\n\n three's 12345 four!! " * 20
    assert encoder.encode(text) == library(text)


def test_edge_rows(edge_docs, library):
    rows = byte_bpe.decode(byte_bpe.encode(edge_docs)).collect()
    expected = [(r["doc_id"], r["text"] or "") for r in edge_docs.collect()]
    got = [(r["doc_id"], np.array(r["ids"], "<u4").tobytes(), bytes(r["decoded"])) for r in rows]
    assert sorted(got, key=lambda r: (r[0] or 0, r[1])) == sorted(
        ((i, library(t), t.encode()) for i, t in expected), key=lambda r: (r[0] or 0, r[1])
    )
    assert byte_bpe.decode(byte_bpe.encode(edge_docs.limit(0), packed=True)).collect() == []


def test_decode_of_foreign_ids(spark):
    rows = spark.createDataFrame([(1, [0, 60_000, -1, None]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in byte_bpe.decode(rows).collect()}
    assert bytes(got[1]) == b"!" + "�".encode() * 3 and got[2] is None and bytes(got[3]) == b""


def test_query_on_all_documents(spark, sample_docs, library):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = set()
    for r in sample_docs.collect():
        text = r["text"] or ""
        ids = library(text)
        expected.add((r["doc_id"], len(ids) // 4, sha(ids), sha(text.encode())))
    rows = queries.op13_byte_bpe(spark, SF_DIR).collect()
    assert len(rows) == sample_docs.count() and {tuple(r) for r in rows} == expected
