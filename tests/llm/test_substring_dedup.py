"""Substring de-duplication against counting all windows."""

from __future__ import annotations

import random
from collections import Counter

from demandloom.llm import substring_dedup


def plain(texts, length):
    parts = [[w for w in (t or "").encode().split()] for t in texts]
    grams = lambda p: [tuple(p[i : i + length]) for i in range(len(p) - length + 1)]
    found = Counter(g for p in parts for g in grams(p))
    out = []
    for p in parts:
        gone = {i + d for i, g in enumerate(grams(p)) if found[g] > 1 for d in range(length)}
        out.append((len(p), len(gone), b" ".join(w for i, w in enumerate(p) if i not in gone).decode()))
    return out


def check(docs, length, seed):
    rows = docs.collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, plain([r.text for r in rows], length))), key=repr)
    done = substring_dedup.remove_repeats(docs, length, seed)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in done.collect()), key=repr) == want
    return done


def test_random_words(make_docs):
    rng = random.Random(5)
    passages = [" ".join(rng.choice("abcdef") + str(rng.randint(0, 9)) for _ in range(rng.randint(8, 40))) for _ in range(4)]
    texts = []
    for _ in range(80):
        bits = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            lo = rng.randint(0, len(p) - 1)
            bits += [" ".join(p[lo : lo + rng.randint(1, 40)]), " ".join(rng.choice("xyz") + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 9)))]
        texts.append("\n".join(bits))
    check(make_docs(list(enumerate(texts))), 7, 3)
    check(make_docs(list(enumerate(texts))), 5, 5)


def test_edge_cases(edge_docs):
    done = check(edge_docs, 6, 2)
    stretches = [r.repeats for r in done.collect() if r.doc_id == 5]
    assert stretches[0] == [(0, 14)]
    assert substring_dedup.remove_repeats(edge_docs.limit(0)).count() == 0


def test_hot_passage(make_docs, no_broadcast):
    passage = " ".join(f"p{i}" for i in range(12))
    check(make_docs([(i, f"u{i} v{i % 7} {passage} {'same' if i % 3 else i} z{i}") for i in range(300)]), 10, 4)
