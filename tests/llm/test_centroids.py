"""Centroids against plain rounds that compute every distance anew."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from demandloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, v int, dots int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, "x", "y", 2, 3) for i, e in rows], SCHEMA)


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in e]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    at = [list(v) for _, v in order[:k]]
    for step in range(rounds + 1):
        got = []
        for i, v in kept:
            found = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in at]
            got.append((i, found.index(min(found)), min(found), v))
        if step < rounds:
            for c in range(len(at)):
                mine = [v for _, n, _, v in got if n == c]
                if mine:
                    at[c] = [sum(x) // len(mine) for x in zip(*mine)]
    total = sum(d for _, _, d, _ in got) if kept else 0
    out = []
    for i, c, d, _ in got if kept else []:
        own = sum(x for _, n, x, _ in got if n == c)
        out.append((i, c, d, own, total, hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest()))
    return out


def same(got, expected):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def vectors(rng, n, dims=64, hot=0):
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dims)]) for i in range(n)]
    return rows + [(n + i, [0.25] * dims) for i in range(hot)]


def test_against_plain_rounds(spark):
    rows = vectors(random.Random(3), 150, hot=60)
    same(centroids.report(frame(spark, rows)).collect(), plain(rows))


def test_edges(spark):
    rng = random.Random(4)
    rows = vectors(rng, 30)
    rows += [(7, rows[7][1]), (7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1])]
    rows += [(90, None), (91, []), (92, [0.1] * 63), (93, [0.1] * 65), (94, [0.1] * 63 + [None])]
    rows += [(95, [0.1] * 63 + [float("nan")]), (96, [float("inf")] * 64), (97, [-0.0] * 64)]
    same(centroids.report(frame(spark, rows)).collect(), plain(rows))


def test_fewer_rows_than_centroids_ties_and_empty_clusters(spark):
    rows = [(i, [0.5] * 64) for i in range(5)] + [(9, [1.0] * 64)]
    got = centroids.report(frame(spark, rows)).collect()
    same(got, plain(rows))
    assert centroids.report(frame(spark, [])).collect() == []
    assert centroids.report(frame(spark, [(1, None)])).collect() == []


def test_other_sizes_and_hot_cluster(spark, no_broadcast):
    rows = vectors(random.Random(5), 40, dims=3, hot=200)
    got = centroids.report(frame(spark, rows), n_centroids=4, rounds=5, dims=3, scale=10).collect()
    same(got, plain(rows, 4, 5, 3, 10))


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.report(frame(spark, [(1, [1e20] * 64)])).collect()
