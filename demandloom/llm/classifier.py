"""Quality classifier: learned subword embeddings, averaged per document, softmax output.

A text becomes hashed features: words, word bigrams (a word repeated right away hashes to
one shared feature) and character n-grams of its UTF-8 bytes, word boundaries included.
Every feature has a learned vector; a document is the average of its vectors; a softmax
layer gives the class.  Training is stochastic gradient descent in numpy over a bounded
sample: at most ``per_class`` labelled documents of each class, those of the smallest id
hashes, weighted so that the classes keep their shares.  Their features are a written table; every
epoch reads it in another order, a part at a time, so the driver never holds the sample, however
long its texts are.  Scoring reads every whole text.

Defined results: a null or empty text has no features and gets the score of the bias; rows
with a null id, label or class other than 0 and 1 teach nothing; a ``doc_id`` labelled both
ways teaches nothing; without both classes the score is the share of class 1 (0.5 without
any label); repeated rows each get their score; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from demandloom.llm.common import prepare, text_of
from demandloom.session import stage

BUCKETS = 1 << 18
DIM = 8
NGRAMS = (3, 4)
#: Bound of the training sample, documents of each class.
PER_CLASS = 2000
EPOCHS = 8
RATE = 1.0
SEED = 7
#: Bytes of a text that are turned into features at a time (cut at white space).
PIECE = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2^64."""
    base, inverse = np.uint64(_ODD), np.uint64(pow(_ODD, -1, 1 << 64))
    up = np.full(n, base, dtype=np.uint64)
    down = np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS = _powers(1 << 12)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        _POWERS = _powers(1 << n.bit_length())
    return _POWERS


def pieces(data: bytes):
    """A text in pieces of bounded size, cut at white space where there is some."""
    start = 0
    while start < len(data):
        end = min(len(data), start + PIECE)
        if end < len(data):
            cut = max(data.rfind(c, start + 1, end) for c in (b" ", b"\n", b"\t"))
            end = cut if cut > start else end
        yield data[start:end]
        start = end


def feature_ids(data: bytes) -> np.ndarray:
    """The hashed features of a piece of text, repeats included."""
    raw = np.frombuffer(b" " + data + b" ", dtype=np.uint8)
    space = _SPACE[raw]
    b = np.where(space, np.uint8(32), raw)
    n = len(b)
    up, down = _grow(n + 1)
    # Words: differences of a running polynomial sum, shifted to a common position.
    running = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=running[1:])
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    if len(starts) == 0:
        return np.zeros(0, dtype=np.int32)
    words = (running[ends] - running[starts]) * down[starts]
    pairs = words[:-1] * np.uint64(3) + words[1:] * np.uint64(5) + np.uint64(11)
    pairs = np.where(words[:-1] == words[1:], np.uint64(1), pairs)
    out = [_bucket(words), _bucket(pairs)]
    wide = b.astype(np.uint64)
    for size in NGRAMS:
        if n < size:
            continue
        gram = np.zeros(n - size + 1, dtype=np.uint64)
        for i in range(size):
            gram |= wide[i : n - size + 1 + i] << np.uint64(8 * i)
        # A blank may stand at either end, not inside.
        inside = np.zeros(n - size + 1, dtype=bool)
        for i in range(1, size - 1):
            inside |= space[i : n - size + 1 + i]
        out.append(_bucket((gram[~inside] + np.uint64(size << 56)) * np.uint64(_ODD)))
    return np.concatenate(out)


def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their shares."""
    ids = [feature_ids(p) for p in pieces(text.encode())]
    ids = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
    if len(ids) == 0:
        return ids, np.zeros(0, dtype=np.float32)
    kinds, counts = np.unique(ids, return_counts=True)
    return kinds.astype(np.int32), (counts / len(ids)).astype(np.float32)


Sample = tuple[np.ndarray, np.ndarray, int, float]


def train(epoch: Callable[[int], Iterable[Sample]], size: int) -> tuple[np.ndarray, float]:
    """Vectors and softmax by stochastic gradient descent over the (ids, shares, label, weight) of each epoch.

    ``size`` is the number of samples of an epoch.  Returned as what scoring needs: each feature's
    contribution to the difference of the two class scores, and the difference of the biases.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = rng.uniform(-1 / DIM, 1 / DIM, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, total = 0, max(1, EPOCHS * size)
    for number in range(EPOCHS):
        for ids, shares, label, weight in epoch(number):
            rate = np.float32(RATE * weight * (1 - steps / total))
            steps += 1
            own = vectors[ids]
            mean = shares @ own
            scores = mean @ layer + bias
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p).astype(np.float32)
            bias -= rate * np.float32(0.1) * p
            # Shares are small; a step per feature in proportion to the square root keeps rare ones learning.
            vectors[ids] = own - rate * np.outer(np.sqrt(shares), back).astype(np.float32)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def held_out(modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def sample_labels(labels: DataFrame, label: str, per_class: int, modulus: int, rest: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled ids of each class outside the held-out fold, and class sizes."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(modulus, rest))
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .filter("label = other").select("doc_id", "label")
    )
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return chosen[0].union(chosen[1]), sizes


def sample_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, text) of the chosen ids: one text each (of the smallest SHA-256), in however many rows an id stands."""
    found = text_of(docs).join(chosen, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, modulus: int = 3, rest: int = 1):
    """The trained model: (contribution per feature, bias)."""
    chosen, sizes = sample_labels(labels, label, per_class, modulus, rest)
    if len(sizes) < 2:
        share = {(): 0.5, (0,): 0.0, (1,): 1.0}[tuple(sizes)]
        return np.zeros(BUCKETS, dtype=np.float32), float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -10, 10))
    rows = sample_texts(docs, chosen)

    def run(batches):
        for batch in batches:
            made = [_document(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0].tobytes() for m in made], pa.binary()), pa.array([m[1].tobytes() for m in made], pa.binary())],
                names=["doc_id", "label", "ids", "shares"],
            )

    # One row per id, so the bound of the ids is that of the rows.
    made = stage(rows.mapInArrow(run, "doc_id long, label int, ids binary, shares binary"), "features")
    used = {r["label"]: r["n"] for r in made.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole, seen = sum(sizes.values()), max(1, sum(used.values()))
    # Half way to the true shares: the rarer class stays visible.
    weight = {c: float(np.sqrt(sizes[c] / whole / (n / seen))) for c, n in used.items()}
    filled = made.filter(F.length("ids") > 0)

    def epoch(number: int):
        ordered = filled.orderBy(F.xxhash64("doc_id", F.lit(number)), "doc_id")
        for row in ordered.toLocalIterator():
            yield np.frombuffer(row.ids, np.int32), np.frombuffer(row.shares, np.float32), row.label, weight[row.label]

    return train(epoch, filled.count())


def score_text(text: str, parts: np.ndarray, bias: float) -> float:
    """The probability of class 1 for one text, all of it."""
    total, count = 0.0, 0
    for piece in pieces(text.encode()):
        ids = feature_ids(piece)
        total += float(parts[ids].sum(dtype=np.float64))
        count += len(ids)
    logit = bias + (total / count if count else 0.0)
    return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def score_texts(docs: DataFrame, model, modulus: int = 3, rest: int = 1, cut: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [score_text(text, *shared.value) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = text_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(modulus, rest).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model, cut: float = 0.5) -> DataFrame:
    """``docs`` without the documents whose score is below ``cut``; all columns pass through.

    The score is a column computed from the text alone, so no join is needed.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: score_text(text or "", *shared.value))

    scored = docs.withColumn("__score", score(F.coalesce("text", F.lit(""))))
    return scored.filter(F.col("__score") >= cut).select(*docs.columns)
