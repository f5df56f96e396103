"""SimHash against pairwise comparison."""

from __future__ import annotations

import random

import xxhash

from demandloom.llm import simhash

WHITE = " \t\n\x0b\x0c\r"


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE:
        text = text.replace(c, " ")
    parts = [w for w in text.split(" ") if w]
    if not parts:
        return 0
    grams = [" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))]
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def roots(values, radius=3):
    """The smallest reachable value of every value, by comparing all pairs."""
    values, parent = sorted(set(values)), {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


def expected(pairs):
    prints = [plain_print(t) for _, t in pairs]
    root = roots(prints)
    best = {}
    for (i, _), p in zip(pairs, prints):
        if i is not None:
            best[root[p]] = min(i, best.get(root[p], i))
    return sorted(((i, f"{p:016x}", best.get(root[p])) for (i, _), p in zip(pairs, prints)), key=repr)


def check(docs):
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == expected(pairs)


def test_edge_cases(edge_docs):
    check(edge_docs)
    assert simhash.near_duplicates(edge_docs.limit(0)).count() == 0


def test_sample(sample_docs):
    check(sample_docs)


def test_masks_cover_every_difference():
    masks = [m & (1 << 64) - 1 for m in simhash.masks()]
    rng = random.Random(1)
    for _ in range(5000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(diff & m == 0 for m in masks)


def test_dense_ball_links_like_all_pairs(spark):
    """Hundreds of values around one centre, with and without large buckets."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rng.sample(range(40), rng.randint(0, 7))) for _ in range(160)} | {rng.getrandbits(64) for _ in range(40)}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    table = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    groups = lambda pairs: {frozenset(v for v, r in pairs if r == root) for _, root in pairs}
    want = {g for g in groups(list(roots(values).items())) if len(g) > 1}
    for limit in (1, 256):
        linked = simhash.components(simhash.fingerprint_links(table, pair_limit=limit)).collect()
        got = groups([(r.node & (1 << 64) - 1, r.root) for r in linked])
        assert got == want


def test_keep_one_keeps_one_of_each_group(edge_docs):
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    pairs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    prints = [plain_print(t) for _, t in pairs]
    root = roots(prints)
    groups = {}
    for (i, _), p in zip(pairs, prints):
        groups.setdefault(root[p], []).append(i)
    first = [min((i for i in g if i is not None), default=None) for g in groups.values()]
    assert sorted((i for i, _ in got), key=repr) == sorted(first, key=repr)
    assert simhash.keep_one(edge_docs.limit(0)).count() == 0
