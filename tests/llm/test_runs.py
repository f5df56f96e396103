"""Runs against a search over all periods, and the digest columns against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from demandloom.llm import queries, runs
from tests.llm.conftest import LONG, SF_DIR


def plain_runs(words, shortest=12):
    """Every maximal stretch per period; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, size, q) for (s, size), q in found.items())


def plain_row(doc_id, words):
    found = plain_runs(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    numbers = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *numbers, sha(lines), sha(kept))


def numbers_of(rng):
    """Few different words, with periodic stretches of random place, length and period."""
    n, kinds = rng.randint(0, 150), rng.choice([1, 2, 3, 6, 20])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n:
            start, period = rng.randrange(n), rng.randint(1, 25)
            for i in range(start, rng.randint(start, n)):
                words[i] = words[start + (i - start) % period]
    return words


def test_all_runs():
    rng = random.Random(11)
    for _ in range(1500):
        words = numbers_of(rng)
        for shortest in (2, 5, 12):
            assert runs.find_runs(np.array(words, np.int64), shortest) == plain_runs(words, shortest)


def test_nested_runs_and_powers():
    inner = [1, 2] * 6
    words = (inner + [3]) * 4
    found = runs.find_runs(np.array(words, np.int64))
    assert found == plain_runs(words)
    assert (0, 52, 13) in found and (13, 12, 2) in found
    assert runs.find_runs(np.zeros(5000, np.int64)) == [(0, 5000, 1)]


def test_words_left_out_hold_no_run():
    rng = random.Random(5)
    for _ in range(300):
        words = numbers_of(rng)
        inside = {i for s, e in runs.repeated_stretches(np.array(words, np.int64), 6) for i in range(s, e)}
        for s, size, _ in plain_runs(words):
            assert inside.issuperset(range(s, s + size))


def test_edge_rows(spark, edge_docs):
    rows = runs.digests(runs.report(edge_docs)).collect()
    assert len(rows) == 10
    expected = []
    for r in edge_docs.collect():
        expected.append(plain_row(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) if r["text"] != LONG else None)
    got = [tuple(r) for r in rows]
    for row in expected:
        if row is not None:
            assert row in got
    empty = runs.digests(runs.report(edge_docs.limit(0)))
    assert empty.collect() == [] and empty.columns == [c for c in rows[0].asDict()]


def test_long_periodic_text(make_docs):
    text = " ".join(f"w{i % 701}" for i in range(60_000))
    [row] = runs.report(make_docs([(1, text)])).collect()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 701)]
    assert row["collapsed"] == " ".join(f"w{i}" for i in range(701))


def test_query_on_all_documents(spark, sample_docs):
    expected = set()
    for r in sample_docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        n, h = len(words), zlib.crc32(str(r["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n < 1500:
            expected.add(plain_row(r["doc_id"], words))
    rows = {tuple(r) for r in queries.op11_periodic_runs(spark, SF_DIR).collect()}
    assert len(rows) == sample_docs.count()
    assert len(expected) > 100 and any(r[1] for r in expected)
    assert expected <= rows
