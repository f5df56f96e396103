from __future__ import annotations

import os

import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, th long, start int, n long, word string, hash long, label int, a long"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))


def rows_of(pairs):
    """Documents with extra columns whose names the operators use inside."""
    return [(i, t, None if k % 2 else "en", 1, 2, 3, "x", 4, 5, 6) for k, (i, t) in enumerate(pairs)]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(pairs):
        return spark.createDataFrame(rows_of(pairs), SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    """Nulls, empty and very long texts, repeated rows, one id with two texts."""
    same = "one two three four five six seven\nalpha beta\n\ngamma delta\nlast line here"
    return make_docs(
        [(None, None), (None, same), (1, ""), (2, same), (2, same), (3, LONG), (3, "short"), (4, " \n\t "), (5, same), (6, "é ß 日本 🤖\nx")]
    )


@pytest.fixture(scope="session")
def sample_docs(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are absent")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
