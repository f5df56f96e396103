"""Toxicity: a learned lexicon, Levenshtein automata for misspellings, scores by context.

The lexicon holds words and word beginnings (stems) that stand mostly in documents labelled
toxic.  It is a trie.  Intersected with the Levenshtein automaton of one edit (a letter
wrong, missing, too many, or two neighbours swapped), it is one automaton that reads a
word once; its states are made when a word first needs them.  Every term is matched so,
whatever its length or first letter.  Two things learned keep short terms from catching
ordinary words: a word that stands in a clean training text is no misspelling, and a misspelled
term counts the less the more such words are one edit away from it.

Around each hit a window of words tells quotation from abuse: quote marks, and cue words
learned from the windows of clean and of toxic training texts.  A logistic model over these
counts gives the score.  All is learned from a bounded sample: at most ``per_class`` labelled
documents of each class outside the held-out fold, those of the smallest id hashes.
Scoring reads every whole text, long ones in slices of words whose windows overlap.

Defined results: a null or empty text has no hits and gets the score of the bias; rows with
a null id, label or class other than 0 and 1 teach nothing, nor does a ``doc_id`` labelled
both ways; without both classes the score is the share of class 1 (0.5 without any label);
repeated rows each get their score and teach once; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.classifier import held_out, sample_labels, sample_texts
from demandloom.llm.common import text_of
from demandloom.session import stage

#: Bound of the training sample, documents of each class; it bounds the lexicon too.
PER_CLASS = 4000
#: A term's uses (told apart by their neighbour words, so that copies count once) must be toxic
#: by this share, and the chance of that many among as many random uses at most e^-EVIDENCE.
MIN_SHARE = 0.8
EVIDENCE = 18.0
STEM_CHARS = (4, 8)
#: Stems must bring together at least so many different words.
MIN_FORMS = 3
WINDOW = 5
EDGE = ".,;:!?*$%&#|()[]{}<>\"'“”„«»‘’…-–—"
QUOTES = set("\"“”„«»‘’")
#: Words and automaton states kept in the memory of a task, and words of one slice of a text.
CACHE_WORDS, CACHE_STATES, SLICE = 400_000, 100_000, 100_000
#: A misspelled term counts as so much of a term, divided by one more than its clean neighbours.
FUZZY_SHARE = 0.5
N_FEATURES = 5
_WORD = re.compile(r"\S+")


class Model(NamedTuple):
    """What training found; ``clean`` are words of clean texts one edit away from a term."""

    terms: list[str]
    shares: list[float]
    clean: list[str]
    quoting: list[str]
    addressing: list[str]
    weights: np.ndarray
    bias: float


def bare(word: str) -> str:
    return word.strip(EDGE)


def slices(text: str, size: int | None = None) -> Iterator[tuple[list[str], int, int]]:
    """(words, first, last): the words of a text in slices, with a window more on both sides."""
    size = size or SLICE
    if len(text) <= size:
        parts = text.split()
        yield parts, 0, len(parts)
        return
    found = (m.group() for m in _WORD.finditer(text))
    before: list[str] = []
    parts = list(islice(found, size + WINDOW))
    while parts:
        after = list(islice(found, size))
        end = len(parts) if not after else len(parts) - WINDOW
        yield before + parts, len(before), len(before) + end
        whole = before + parts
        before = whole[max(0, len(before) + end - WINDOW) : len(before) + end]
        parts = (parts[end:] + after) if after else []


class Lexicon:
    """The trie of the terms, run as an automaton that allows one edit.

    A trailing ``*`` marks a stem, which matches any longer word.  A position is (node, edits
    left, letter): with a letter, that one must come next, as the second of a swapped pair.
    A state is all positions a beginning of a word leads to, and the stems it has passed.
    """

    def __init__(self, terms: list[str]):
        self.below: list[dict[str, int]] = [{}]
        self.word_end, self.stem_end = {}, {}
        for number, term in enumerate(terms):
            node = 0
            for c in term.rstrip("*"):
                if c not in self.below[node]:
                    self.below[node][c] = len(self.below)
                    self.below.append({})
                node = self.below[node][c]
            (self.stem_end if term.endswith("*") else self.word_end)[node] = number
        self.letters = {c for node in self.below for c in node}
        self._restart()

    def _restart(self) -> None:
        self.numbers: dict = {}
        self.states: list = []
        self.moves: list[dict[str, int]] = []
        self.start = self._number(self._reached({(0, 1, "")}, False, frozenset()))

    def _reached(self, positions: set, exact: bool, fuzzy: frozenset) -> tuple:
        """A state: with the letters that may be missing, and the stems at its nodes."""
        missing = {(child, 0, "") for node, left, _ in positions if left for child in self.below[node].values()}
        every = frozenset(positions | missing)
        stems = [(left, self.stem_end[node]) for node, left, c in every if not c and node in self.stem_end]
        return every, exact or any(left for left, _ in stems), fuzzy | {t for left, t in stems if not left}

    def _number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return self.numbers[state]

    def _step(self, state: tuple, c: str) -> tuple:
        positions, exact, fuzzy = state
        out = set()
        for node, left, wanted in positions:
            if wanted:
                if wanted == c:
                    out.add((node, 0, ""))
                continue
            below = self.below[node]
            if c in below:
                out.add((below[c], left, ""))
            if left:
                out.add((node, 0, ""))  # a letter too many
                for a, child in below.items():
                    if a != c:
                        out.add((child, 0, ""))  # a letter wrong
                        if c in self.below[child]:
                            out.add((self.below[child][c], 0, a))  # two letters swapped
        return self._reached(out, exact, fuzzy)

    def find(self, word: str) -> tuple[bool, frozenset]:
        """Whether a word is a term, and the terms that it is one edit away from."""
        if len(self.states) > CACHE_STATES:
            self._restart()
        at = self.start
        for c in word:
            key = c if c in self.letters else ""
            to = self.moves[at].get(key)
            if to is None:
                to = self._number(self._step(self.states[at], key))
                self.moves[at][key] = to
            at = to
        positions, exact, fuzzy = self.states[at]
        ends = [(left, self.word_end[node]) for node, left, c in positions if not c and node in self.word_end]
        return exact or any(left for left, _ in ends), fuzzy | {t for left, t in ends if not left}


class Scanner:
    """Counts of a text's hits by kind; keeps what it found out about a bounded number of words."""

    def __init__(self, model: Model):
        self.model, self.lexicon = model, Lexicon(model.terms)
        self.clean, self.quoting, self.addressing = map(frozenset, (model.clean, model.quoting, model.addressing))
        self.known: dict[str, float] = {}

    def look_up(self, word: str) -> float:
        """1 for a term, the share of a misspelled one, else 0."""
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        plain, value = bare(word.lower()), 0.0
        if len(plain) >= 2:
            exact, near = self.lexicon.find(plain)
            if exact:
                value = 1.0
            elif near and plain not in self.clean:
                value = max(self.model.shares[t] for t in near)
        self.known[word] = value
        return value

    def hits(self, parts: list[str], first: int, last: int) -> list[tuple[int, float]]:
        known, out = self.known, []
        for i in range(first, last):
            value = known.get(parts[i])
            if value is None:
                value = self.look_up(parts[i])
            if value:
                out.append((i, value))
        return out

    def features(self, text: str) -> list[float]:
        direct, quoted, addressed, n = 0.0, 0.0, 0.0, 0
        for parts, first, last in slices(text):
            n += last - first
            for i, value in self.hits(parts, first, last):
                plain = window_words(parts, i)
                if in_quotes(parts, i) or plain & self.quoting:
                    quoted += value
                else:
                    direct += value
                if plain & self.addressing:
                    addressed += value
        return [
            float(direct >= FUZZY_SHARE), float(np.log1p(direct)), float(np.log1p(quoted)), float(np.log1p(addressed)),
            100.0 * direct / (n + 100.0),
        ]


def window_words(parts: list[str], i: int) -> set[str]:
    """The words around word ``i``, without itself."""
    return {bare(w.lower()) for w in parts[max(0, i - WINDOW) : i] + parts[i + 1 : i + WINDOW + 1]}


def in_quotes(parts: list[str], i: int) -> bool:
    """Whether word ``i`` bears a quote mark, or a quotation opens before it and closes after it, within the window."""
    if parts[i][0] in QUOTES or parts[i].rstrip(".,;:!?")[-1:] in QUOTES:
        return True
    before = any(w[0] in QUOTES and w[-1] not in QUOTES for w in parts[max(0, i - WINDOW) : i])
    after = any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in parts[i + 1 : i + 1 + WINDOW])
    return before and after


def uses(parts: list[str], first: int, last: int) -> set[tuple[str, int]]:
    """The words of a slice and their stems, each with a hash of its neighbour words."""
    plain = [bare(w.lower()) for w in parts]
    out = set()
    for i in range(first, last):
        word = plain[i]
        if len(word) >= 3:
            around = " ".join((plain[i - 1] if i else "", word, plain[i + 1] if i + 1 < len(plain) else ""))
            place = xxhash.xxh64_intdigest(around.encode()) >> 1
            out.add((word, place))
            out.update((word[:k] + "*", place) for k in range(STEM_CHARS[0], min(STEM_CHARS[1], len(word) - 1) + 1))
    return out


def contexts(scan: Scanner, parts: list[str], first: int, last: int) -> set[tuple[str, int]]:
    """The words around the hits of a slice, each with a hash of the whole window."""
    out = set()
    for i, _ in scan.hits(parts, first, last):
        words = window_words(parts, i)
        place = xxhash.xxh64_intdigest(" ".join(sorted(words)).encode()) >> 1
        out.update((w, place) for w in words if w)
    return out


def _counted(sample: DataFrame, of, name: str) -> DataFrame:
    """(term, toxic, n): different uses of each term that ``of`` finds in a slice; copies count once."""

    def run(batches):
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in slices(text):
                    found = sorted(of(*part))
                    if found:
                        terms, places = zip(*found)
                        columns = [pa.array(terms), pa.array(places, pa.int64()), pa.array([label] * len(terms), pa.int32())]
                        yield pa.RecordBatch.from_arrays(columns, names=["term", "place", "label"])

    placed = sample.select("label", "text").mapInArrow(run, "term string, place long, label int")
    once = placed.groupBy("term", "place").agg(F.max("label").alias("label"))
    return stage(once.groupBy("term").agg(F.sum("label").cast("double").alias("toxic"), F.count("*").cast("double").alias("n")), name)


def _evidence(usual: float):
    """Chernoff bound of a binomial tail: how far the toxic share is from the usual one."""
    share, rest = F.col("toxic") / F.col("n"), 1 - F.col("toxic") / F.col("n")
    part = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    return F.col("n") * (part(share, usual) + part(rest, 1 - usual))


def _usual(counted: DataFrame) -> float | None:
    whole = counted.agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).first()
    return whole["toxic"] / whole["n"] if whole["n"] and whole["toxic"] else None


def learn_terms(counted: DataFrame) -> list[str]:
    """The lexicon: all terms that are toxic beyond chance."""
    # Words only: stems would count a use several times.
    usual = _usual(counted.filter(~F.col("term").endswith("*")))
    if usual is None:
        return []
    usual = min(usual, MIN_SHARE / 2)
    beyond = counted.filter((F.col("toxic") > 0) & (F.col("toxic") / F.col("n") >= MIN_SHARE)).withColumn("evidence", _evidence(usual))
    # Each needs several different uses in the sample, whose size is bounded.
    rows = beyond.filter(F.col("evidence") >= EVIDENCE).orderBy(F.desc("evidence"), F.length("term"), "term").collect()
    words = sorted(r["term"] for r in rows if not r["term"].endswith("*"))
    chosen: list[str] = []
    stems: set[str] = set()
    for r in rows:
        term = r["term"]
        begin = term.rstrip("*")
        if any(begin[:k] in stems for k in range(STEM_CHARS[0], len(begin) + 1)):
            continue
        if term.endswith("*"):
            if bisect_left(words, begin + "\U0010ffff") - bisect_left(words, begin) < MIN_FORMS:
                continue
            stems.add(begin)
        chosen.append(term)
    return chosen


def learn_neighbours(counted: DataFrame, terms: list[str]) -> tuple[list[float], list[str]]:
    """What a misspelling of each term counts, and the words of clean texts that are none."""
    clean = counted.filter((F.col("n") > F.col("toxic")) & ~F.col("term").endswith("*")).select("term")

    def run(batches):
        lexicon = Lexicon(terms)
        for batch in batches:
            found = [(w, sorted(near)) for w in batch.column(0).to_pylist() for exact, near in [lexicon.find(w)] if near and not exact]
            columns = [pa.array([w for w, _ in found], pa.string()), pa.array([t for _, t in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "terms"])

    # Different words of the bounded sample that are one edit away from a term.
    rows = clean.mapInArrow(run, "word string, terms array<int>").collect()
    crowd = [0] * len(terms)
    for r in rows:
        for t in r["terms"]:
            crowd[t] += 1
    return [FUZZY_SHARE / (1 + k) for k in crowd], sorted(r["word"] for r in rows)


def learn_cues(sample: DataFrame, model: Model) -> tuple[list[str], list[str]]:
    """Words that stand around hits in clean texts, or in toxic ones, beyond chance."""
    scan = Scanner(model)
    counted = _counted(sample, lambda *part: contexts(scan, *part), "cue-uses")
    usual = _usual(counted)
    if usual is None or usual >= 1:
        return [], []
    share = F.col("toxic") / F.col("n")
    rows = counted.withColumn("share", share).filter(_evidence(usual) >= EVIDENCE).select("term", "share").collect()
    quoting = sorted(r["term"] for r in rows if r["share"] <= usual / 2)
    return quoting, sorted(r["term"] for r in rows if r["share"] >= (1 + usual) / 2)


def fit_weights(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + ridge * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, modulus: int = 4, rest: int = 2) -> Model:
    """The trained model."""
    chosen, sizes = sample_labels(labels, label, per_class, modulus, rest)
    model = Model([], [], [], [], [], np.zeros(N_FEATURES), 0.0)
    if len(sizes) < 2:
        share = {(): 0.5, (0,): 0.0, (1,): 1.0}[tuple(sizes)]
        return model._replace(bias=float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -10, 10)))
    sample = stage(sample_texts(docs, chosen), "toxicity-sample")
    used = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    counted = _counted(sample, uses, "term-uses")
    terms = learn_terms(counted)
    shares, clean = learn_neighbours(counted, terms)
    model = model._replace(terms=terms, shares=shares, clean=clean)
    quoting, addressing = learn_cues(sample, model)
    model = model._replace(quoting=quoting, addressing=addressing)

    def run(batches):
        scan = Scanner(model)
        for batch in batches:
            rows = [scan.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])

    # One row per id of the sample, which bounds these rows; sorted here, so that sums don't depend on tasks.
    found = sample.select("label", "text").mapInArrow(run, "label int, x array<double>").toArrow()
    rows = sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))
    y = np.array([r[0] for r in rows], dtype=float)
    x = np.array([r[1] for r in rows], dtype=float).reshape(len(y), N_FEATURES)
    weights, bias = fit_weights(x, y)
    # The sample holds the classes in other shares than the corpus.
    shift = np.log(sizes[1] / sizes[0]) - np.log(max(1, used.get(1, 0)) / max(1, used.get(0, 0)))
    return model._replace(weights=weights, bias=bias + float(shift))


def score_texts(docs: DataFrame, model: Model, modulus: int = 4, rest: int = 2, cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        known = Model(*shared.value)
        scan = Scanner(known)
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                z = known.bias + float(np.dot(known.weights, scan.features(text)))
                scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = text_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(modulus, rest).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
