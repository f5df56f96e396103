"""Features, training and score of the quality classifier against plain loops."""

from __future__ import annotations

import math

import numpy as np
import pytest

from demandloom.llm import classifier

MASK = (1 << 64) - 1
ODD = classifier._ODD
TEXTS = ["the cat sat", "the the cat", "a", "", "  ", "é ß 日本 🤖\nx\tzz  zz", "one two three four five six seven eight", "x" * 40]


def bucket(h):
    h &= MASK
    h ^= h >> 29
    return (h * 0xBF58476D1CE4E5B9 & MASK) >> 64 - classifier.BUCKETS.bit_length() + 1


def features(text):
    data = text.encode()
    if not data:
        return []
    words = data.split()
    hashes = [sum((c + 1) * pow(ODD, j, 1 << 64) for j, c in enumerate(w)) & MASK for w in words]
    if not words:
        return []
    out = [bucket(h) for h in hashes]
    out += [bucket(1 if a == b else 3 * a + 5 * b + 11) for a, b in zip(hashes, hashes[1:])]
    padded = b" " + bytes(32 if c in b" \t\n\x0b\x0c\r" else c for c in data) + b" "
    for size in classifier.NGRAMS:
        for at in range(len(padded) - size + 1):
            gram = padded[at : at + size]
            if b" " not in gram[1:-1]:
                out.append(bucket((int.from_bytes(gram, "little") + (size << 56)) * ODD))
    return out


@pytest.mark.parametrize("text", TEXTS)
def test_features(text):
    got = [int(i) for p in classifier.pieces(text.encode()) for i in classifier.feature_ids(p)]
    assert sorted(got) == sorted(features(text))


def plain_train(samples, epochs):
    rng = np.random.default_rng(classifier.SEED)
    size, dim = classifier.BUCKETS, classifier.DIM
    start = rng.uniform(-1 / dim, 1 / dim, (size, dim)).astype(np.float32)
    layer = [[float(x) for x in r] for r in rng.uniform(-1 / dim, 1 / dim, (dim, 2)).astype(np.float32)]
    vectors, bias, steps = {}, [0.0, 0.0], 0
    for order in epochs:
        for text, label, weight in (samples[i] for i in order):
            found = features(text)
            share = {k: found.count(k) / len(found) for k in set(found)}
            rate = classifier.RATE * weight * (1 - steps / (len(samples) * len(epochs)))
            steps += 1
            own = {k: vectors.get(k, [float(x) for x in start[k]]) for k in share}
            mean = [sum(share[k] * own[k][d] for k in share) for d in range(dim)]
            scores = [sum(mean[d] * layer[d][c] for d in range(dim)) + bias[c] for c in (0, 1)]
            e = [math.exp(s - max(scores)) for s in scores]
            miss = [e[c] / sum(e) - (c == label) for c in (0, 1)]
            back = [sum(layer[d][c] * miss[c] for c in (0, 1)) for d in range(dim)]
            for c in (0, 1):
                bias[c] -= rate * 0.1 * miss[c]
                for d in range(dim):
                    layer[d][c] -= rate * mean[d] * miss[c]
            for k in share:
                vectors[k] = [own[k][d] - rate * math.sqrt(share[k]) * back[d] for d in range(dim)]
    parts = {k: sum(v[d] * (layer[d][1] - layer[d][0]) for d in range(dim)) for k, v in vectors.items()}
    return parts, bias[1] - bias[0]


def test_training_and_score(monkeypatch):
    monkeypatch.setattr(classifier, "EPOCHS", 3)
    samples = [("the cat sat on the mat", 1, 1.2), ("buy buy buy now", 0, 0.7), ("a quiet day in the hills", 1, 1.2)]
    orders = [[0, 1, 2], [2, 0, 1], [1, 2, 0]]
    made = [(*classifier._document(t), label, weight) for t, label, weight in samples]
    parts, bias = classifier.train(lambda e: (made[i] for i in orders[e]), len(made))
    want, want_bias = plain_train(samples, orders)
    assert bias == pytest.approx(want_bias, abs=1e-5)
    for k, v in want.items():
        assert float(parts[k]) == pytest.approx(v, abs=1e-4)
    for text, _, _ in samples:
        found = features(text)
        logit = want_bias + sum(want[k] for k in found) / len(found)
        assert classifier.score_text(text, parts, bias) == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-4)


def test_ties_long_texts_and_repeated_rows(spark, make_docs):
    """The same sample, however often its rows stand and in whatever order: the same model."""
    long = " ".join(f"word{i % 3001}" for i in range(200_000))
    pairs = [(k, long if k == 4 else f"{'good plain words' if k % 2 else 'win win now'} {k % 5}") for k in range(24)] + [(90, None), (None, "x")]
    labels = spark.createDataFrame([(k, k % 2, 1) for k in range(24)] + [(90, 1, 1), (None, 0, 1)], "doc_id long, quality int, text int")
    first = classifier.fit(make_docs(pairs), labels)
    again = classifier.fit(make_docs(pairs[::-1] + pairs), labels.union(labels))
    assert np.array_equal(first[0], again[0]) and first[1] == again[1]
    assert classifier.score_text("good plain words", *first) > 0.5 > classifier.score_text("win win now", *first)
