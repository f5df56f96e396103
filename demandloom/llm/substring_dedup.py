"""Substring de-duplication: seed and extend on winnowed anchors.

A window is ``length`` consecutive words.  Each window picks one seed, the smallest hash of
its ``seed``-word sequences (the last one on a tie); equal windows pick the same seed at the
same place.  The windows of one pick form a run, so a document is a short list of runs.

Seed: runs are joined on their anchor, the hash of the seed.  An anchor found once has no
repeat.  Extend: where all runs of an anchor reach equally far to both sides (one segment
hash), every window of them repeats.  Where they differ, runs of a segment found twice or
more repeat as a whole; one run for each different segment is opened again in its text and
its windows are counted one by one, which finds how far each match reaches.  Repeats that
touch are merged to maximal ones.

Nothing is compared pair by pair and no group is gathered: anchors, segments and windows are
counted with map-side combine, and hot anchors are joins that Spark can split.  Segments and
windows are known by two 64-bit hashes.

Defined results: a null text has no words; a text of fewer than ``length`` words has no window
and stays; a null ``doc_id`` is carried through; repeated rows count as repeats of each other
(windows are judged on the input); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import text_of
from demandloom.session import stage

LENGTH = 35
SEED = 8
#: Words whose hash a task remembers.
CACHE_WORDS = 300_000
_FIRST = 0x9E3779B97F4A7C15
_SECOND = 0xD1B54A32D192ED03


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class Rolling:
    """Hashes of word sequences by differences of running sums modulo 2^64."""

    def __init__(self):
        self.words = _Hashes()
        self.powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _powers(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = self.powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(1 << 12, 1 << (n - 1).bit_length())
            up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            have = self.powers[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return have

    def sums(self, hashes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(hashes)
        up, down = self._powers(base, n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=out[1:])
        return out, down

    def word_hashes(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, parts), np.uint64, len(parts))


def sequence(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total, down = sums
    return _mixed((total[end] - total[start]) * down[start])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def runs_of(rolling: Rolling, parts: list[bytes], length: int, seed: int):
    """(anchor, segment, start, count) of every run of windows, as arrays."""
    n = len(parts)
    if n < length:
        return None
    hashes = rolling.word_hashes(parts)
    first, second = rolling.sums(hashes, _FIRST), rolling.sums(hashes, _SECOND)
    at = np.arange(n - seed + 1)
    value, place = sequence(first, at, at + seed), at
    seeds = value
    # Smallest value of a span of seeds, the last one on a tie: spans double, then overlap.
    span, width = 1, length - seed + 1
    while span < width:
        step = min(span, width - span)
        left = value[:-step] < value[step:]
        value = np.where(left, value[:-step], value[step:])
        place = np.where(left, place[:-step], place[step:])
        span += step
    cut = np.flatnonzero(place[1:] != place[:-1]) + 1
    start = np.concatenate(([0], cut))
    count = np.diff(np.concatenate((start, [len(place)])))
    segment = sequence(second, start, start + count + length - 1)
    return seeds[place[start]].view(np.int64), segment.view(np.int64), start, count


def find_runs(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, th, a, s, start, n): the runs of windows of every document."""

    def run(batches):
        rolling = Rolling()
        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = runs_of(rolling, text.encode().split(), length, seed)
                if found is not None:
                    held.append((batch.slice(i, 1), found))
                    size += len(found[0])
                if size >= 50_000:
                    yield together(held)
                    held, size = [], 0
            if held:
                yield together(held)

    def together(held):
        sizes = [len(found[0]) for _, found in held]
        take = np.repeat(np.arange(len(held)), sizes)
        ids = pa.Table.from_batches([row for row, _ in held]).select(["doc_id", "th"]).take(pa.array(take)).combine_chunks()
        a, s, start, count = (np.concatenate([found[k] for _, found in held]) for k in range(4))
        return pa.RecordBatch.from_arrays(
            [ids.column(0).chunk(0), ids.column(1).chunk(0), pa.array(a), pa.array(s), pa.array(start, pa.int32()), pa.array(count, pa.int32())],
            names=["doc_id", "th", "a", "s", "start", "n"],
        )

    keyed = text_of(docs).select("doc_id", F.xxhash64("text").alias("th"), "text")
    return keyed.mapInArrow(run, "doc_id long, th long, a long, s long, start int, n int")


def open_runs(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, at, w1, w2, copies): the windows of the given runs, from their texts."""
    # A document's runs are fewer than its words.
    wanted = runs.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n", "copies")).alias("runs")).select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "runs"
    )
    texts = text_of(docs).withColumn("th", F.xxhash64("text"))
    # A repeated row is opened once: its runs are counted in ``copies``.
    joined = texts.join(wanted.hint("merge"), F.expr("doc_id <=> __id and th = __th")).select("doc_id", "th", "text", "runs")

    def run(batches):
        rolling = Rolling()
        for batch in batches:
            for i, (text, runs) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                hashes = rolling.word_hashes(text.encode().split())
                at = np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in runs])
                copies = np.concatenate([np.full(r["n"], r["copies"]) for r in runs])
                w1 = sequence(rolling.sums(hashes, _FIRST), at, at + length)
                w2 = sequence(rolling.sums(hashes, _SECOND), at, at + length)
                take = pa.array(np.full(len(at), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(at, pa.int32()), pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(copies, pa.int64())],
                    names=["doc_id", "th", "at", "w1", "w2", "copies"],
                )

    opened = joined.mapInArrow(run, "doc_id long, th long, at int, w1 long, w2 long, copies long")
    return opened


def covered_words(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, th, start, end): stretches of words that are repeated; they may overlap."""
    runs = find_runs(docs, length, seed)
    # Written, so that the join below has two plain sides and a hot anchor can be split.
    anchors = stage(
        runs.groupBy("a").agg(F.count("*").alias("found"), F.min("s").alias("low"), F.max("s").alias("high"))
        .filter("found > 1").select("a", (F.col("low") == F.col("high")).alias("same")),
        "anchors",
    )
    # The texts are read again here: cheaper than keeping every run of the corpus on disk.
    seeded = stage(runs.join(anchors, "a"), "seeded-runs")
    whole = seeded.filter("same").select("doc_id", "th", "start", "n")
    mixed = seeded.filter("not same")
    segments = stage(
        mixed.groupBy("a", "s").agg(
            F.count("*").alias("copies"), F.first("doc_id").alias("doc_id"), F.first("th").alias("th"), F.first("start").alias("start"), F.first("n").alias("n")
        ),
        "segments",
    )
    # Joins below take written tables for the same reason.
    twice = segments.filter("copies > 1").select("a", "s")
    again = mixed.join(twice, ["a", "s"]).select("doc_id", "th", "start", "n")
    windows = stage(open_runs(docs, segments, length).dropDuplicates(["doc_id", "th", "at"]), "edge-windows")
    repeated = stage(windows.groupBy("w1", "w2").agg(F.sum("copies").alias("found")).filter("found > 1").select("w1", "w2"), "repeated-windows")
    edges = (
        windows.filter("copies = 1").join(repeated, ["w1", "w2"])
        .select("doc_id", "th", F.col("at").alias("start"), F.lit(1).alias("n"))
    )
    every = whole.union(again).union(edges)
    return every.select("doc_id", "th", "start", (F.col("start") + F.col("n") + (length - 1)).alias("end"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, repeats, kept) per document.

    ``repeats`` are the maximal repeated stretches as (start, end) in words; ``kept`` is the
    rest, words joined by one blank.
    """
    stretches = stage(
        covered_words(docs, length, seed).groupBy("doc_id", "th")
        # A document's stretches are fewer than its words.
        .agg(F.collect_set(F.struct("start", "end")).alias("covered"))
        .select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "covered"),
        "repeated-words",
    )
    texts = text_of(docs).withColumn("th", F.xxhash64("text"))
    joined = texts.join(stretches.hint("merge"), F.expr("doc_id <=> __id and th = __th"), "left").select("doc_id", "text", "covered")

    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for text, covered in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = text.encode().split()
                merged: list[list[int]] = []
                for c in sorted((c["start"], c["end"]) for c in covered or ()):
                    if merged and c[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], c[1])
                    else:
                        merged.append(list(c))
                kept, at = [], 0
                for start, end in merged:
                    kept += parts[at:start]
                    at = end
                kept += parts[at:]
                for column, value in zip(out, (len(parts), len(parts) - len(kept), [{"start": s, "end": e} for s, e in merged], b" ".join(kept).decode())):
                    column.append(value)
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], spans), pa.array(out[3], pa.string())],
                names=["doc_id", "n_words", "n_removed", "repeats", "kept"],
            )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, repeats array<struct<start:long,end:long>>, kept string")
