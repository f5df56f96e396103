"""Periodic runs of words: suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends, of at least ``max(shortest, 2 * q)`` words.

The states of a suffix automaton are the classes of substrings with the same end positions;
suffix links make them a tree.  Words are appended one by one, and each append *accesses* its
prefix's state: the path to the root becomes one preferred path with the new end position.
Before that the path consists of segments, each with the end position of its own last
access.  A segment that ended at e, with longest string L, says that L words before e and
before the new end i are the same.  If i - e <= L, then two equal blocks of i - e words
stand side by side, a square, which is extended to both sides.  The block of a run's period
occurs last exactly one period before, so every run shows.  Segments are splay trees
(link-cut access), so a text of n words has O(n log n) recolourings.

Words that no run can hold are left out first, without loss: a run of at least 12 words with
period q <= half its length repeats at a distance of q at least 6 words, so each of its words
lies in a 6-word window that occurs twice.  Stretches of such words are taken apart until
nothing more goes; the automaton runs on each that is left.

Defined results: one row per input row, repeated rows and null ids included; a null text has no
words; words are compared as they are; a text of any length is one row and is never
shortened; other columns are ignored; an empty table gives an empty result.  Ties: runs are
listed by start, then period; of periods that fit the same stretch only the smallest counts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import prepare, text_of, words

SHORTEST = 12
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_stretches(codes: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal stretches of at least two windows, each word in a window that occurs twice in its stretch."""
    n = len(codes)
    if n < 2 * window:
        return []
    # A number for each window, exact: pairs of numbers are renumbered, doubling the length.
    grams, size = codes, 1
    while size < window:
        step = min(size, window - size)
        both = grams[: len(grams) - step] * (int(grams.max()) + 1) + grams[step:]
        grams, size = np.unique(both, return_inverse=True)[1], size + step
    owner = np.zeros(len(grams), np.int64)
    before = -1
    while True:
        # A window counts where it occurs again among the windows of the same stretch.
        live = np.flatnonzero(owner >= 0)
        key = owner[live] * (len(grams) + 1) + grams[live]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        again = live[counts[inverse] > 1]
        if not again.size:
            return []
        steps = np.zeros(n + 1, np.int64)
        np.add.at(steps, again, 1)
        np.add.at(steps, again + window, -1)
        covered = np.concatenate(([0], np.cumsum(steps[:-1]) > 0, [0])).astype(np.int8)
        edges = np.flatnonzero(np.diff(covered))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= 2 * window
        starts, ends = starts[long], ends[long]
        left = int((ends - starts).sum())
        if left == before or not left:
            return list(zip(starts.tolist(), ends.tolist()))
        before, owner = left, np.full(len(grams), -1, np.int64)
        for k, (s, e) in enumerate(zip(starts, ends)):
            owner[s : e - window + 1] = k


def automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and longest lengths of the states, and the state of every prefix."""
    link, length, follow, prefix = [-1], [0], [{}], []
    last = 0
    for code in codes:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        follow.append({})
        prefix.append(new)
        at = last
        while at >= 0 and code not in follow[at]:
            follow[at][code] = new
            at = link[at]
        if at >= 0:
            to = follow[at][code]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                # The shorter strings of that state occur here too, its longer ones don't.
                copy = len(link)
                link.append(link[to])
                length.append(length[at] + 1)
                follow.append(dict(follow[to]))
                link[to] = link[new] = copy
                while at >= 0 and follow[at].get(code) == to:
                    follow[at][code] = copy
                    at = link[at]
        last = new
    return link, length, prefix


class LinkCut:
    """Preferred paths of a rooted tree as splay trees; each has the value of its last access.

    Only access is needed: the tree does not change while words are appended.
    """

    def __init__(self, parents: list[int]):
        n = len(parents)
        self.parent = list(parents)  # in the splay tree; at its root, the tree parent of the path
        self.left, self.right = [-1] * n, [-1] * n
        self.value = [-1] * n  # kept at the root of each splay tree

    def _splay(self, x: int) -> None:
        """Make x the root of its splay tree; the path's value moves to it."""
        parent, left, right = self.parent, self.left, self.right
        top = x
        while (p := parent[top]) >= 0 and (left[p] == top or right[p] == top):
            top = p
        self.value[x] = self.value[top]
        while x != top:
            p = parent[x]
            if p != top:
                same_side = (left[parent[p]] == p) == (left[p] == x)
                if parent[p] == top:
                    top = x
                self._rotate(p if same_side else x)
            else:
                top = x
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        p = parent[x]
        g = parent[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            parent[inner] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        parent[p], parent[x] = x, g

    def access(self, node: int, value: int) -> list[tuple[int, int]]:
        """Recolour the path from the root; (deepest state, former value) per segment, from below."""
        found, below, at = [], -1, node
        while at >= 0:
            self._splay(at)
            was = self.value[at]
            if was >= 0:
                found.append((at, was))
            deeper = self.right[at]
            if deeper >= 0:
                # What hangs deeper stays a segment of its own with the former value.
                self.value[deeper] = was
            self.right[at] = below
            below, at = at, self.parent[at]
        self._splay(node)
        self.value[node] = value
        return found


def find_runs(codes: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    window = shortest // 2
    best: dict[tuple[int, int], int] = {}
    for first, stop in repeated_stretches(codes, window):
        part = codes[first:stop].tolist()
        n = len(part)
        link, length, prefix = automaton(part)
        tree = LinkCut(link)
        # Where the run of a period ends that was found last: squares inside it are the same run.
        reach: dict[int, int] = {}
        for i, state in enumerate(prefix):
            for deepest, e in tree.access(state, i):
                period = i - e
                if period > length[deepest] or reach.get(period, -1) > i:
                    continue
                end = i + 1
                while end < n and part[end] == part[end - period]:
                    end += 1
                start = i - 2 * period + 1
                while start > 0 and part[start - 1] == part[start - 1 + period]:
                    start -= 1
                reach[period] = end
                if end - start >= shortest:
                    key = (first + start, end - start)
                    best[key] = min(period, best.get(key, period))
    return sorted((start, size, period) for (start, size), period in best.items())


def report(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed``: the words with each run cut to its first period.

    ``runs`` is an array of (start, length, period), in words.
    """
    prepare(docs.sparkSession)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def one(text: str):
        found = _WORD.findall(text)
        numbers: dict[str, int] = {}
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))
        runs = find_runs(codes, shortest)
        if runs:
            steps = np.zeros(len(found) + 1, np.int64)
            for start, size, period in runs:
                steps[start + period] += 1
                steps[start + size] -= 1
            gone = np.cumsum(steps[:-1]) > 0
            kept = [w for w, g in zip(found, gone.tolist()) if not g]
        else:
            kept = found
        return len(found), [{"start": s, "length": k, "period": p} for s, k, p in runs], " ".join(kept)

    def run(batches):
        for batch in batches:
            rows = [one((t or b"").decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            n, runs, kept = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(n, pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "runs", "collapsed"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def digests(found: DataFrame) -> DataFrame:
    """What ``report`` found as one flat row per document."""
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("size"), (-r["start"]).alias("a"), (-r["period"]).alias("q"))))
    size, start, period = longest["size"], -longest["a"], -longest["q"]
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        start.alias("start"),
        size.alias("length"),
        period.alias("period"),
        F.floor(size * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """``documents`` where one id in ten has a periodic tail, by a rule on the id's checksum.

    With h the CRC-32 of the id in decimal and g = h div 10, if h mod 10 is 0 each word
    i >= a becomes word a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    docs = text_of(docs)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found, n = F.col("_w"), F.size("_w").cast("long")
    g = F.floor(h / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))

    def altered(i: Column) -> Column:
        return F.get(found, F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p"))).cast("int"))

    chosen = F.when((F.pmod(h, F.lit(10)) == 0), words(F.col("text")))
    some = docs.withColumn("_w", chosen)
    some = some.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p))
    tail = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), altered), " ")
    return some.select("doc_id", F.when(F.col("_a").isNotNull(), tail).otherwise(F.col("text")).alias("text"))
