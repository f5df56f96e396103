"""Quality rules against plain counts; cutoffs against the exact binomial tail."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from demandloom.llm import quality_rules

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    parts = [w for w in WHITE.split(text) if w]
    lines = [x for x in text.split("\n") if WHITE.sub("", x)]
    grams = Counter(tuple(parts[i : i + 8]) for i in range(len(parts) - 7))
    covered = {i + d for i in range(len(parts) - 7) if grams[tuple(parts[i : i + 8])] > 1 for d in range(8)}
    n = len(parts)
    return (n, sum(map(len, parts)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def base(rows):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=repr)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, lang string")


def check(docs, labels):
    got = quality_rules.apply_rules(docs, labels).collect()
    assert base(got) == sorted(((r.doc_id, *plain(r.text)) for r in docs.collect()), key=repr)
    assert not any(r.kept and r.base_failed for r in got)
    return got


def test_edge_cases(spark, edge_docs):
    labels = labels_of(spark, [(None, 1, "x"), (2, None, "x"), (2, 1, None), (2, 0, "y"), (99, 1, "en")])
    got = check(edge_docs, labels)
    assert all(r.kept != r.base_failed for r in got)  # nothing learned
    check(edge_docs, labels.limit(0))
    assert quality_rules.apply_rules(edge_docs.limit(0), labels).count() == 0


def test_repeats(make_docs, spark):
    run = " ".join(f"w{i}" for i in range(30))
    texts = [run, f"{run} x {run}", "a " * 50, f"{run} {run[:29]}", "a b c d e f g h\n" * 3, "# | $ <b>\n\n# | $ <b>"]
    check(make_docs(list(enumerate(texts))), labels_of(spark, []))


def test_sample(spark, sample_docs):
    check(sample_docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))


def test_lower_tail(spark):
    cells = [(k, n) for n in (1, 10, 200, 3000) for k in (0, 1, n // 50, n // 20)]
    df = spark.createDataFrame(cells, "k long, n long").withColumn("p", quality_rules.lower_tail(F.col("k"), F.col("n"), 0.05))
    for r in df.collect():
        exact = sum(math.comb(r.n, i) * 0.05**i * 0.95 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == 1.0 if r.k > 0.05 * r.n else abs(r.p - exact) < 1e-9


def test_lower_tail_of_many_terms(spark):
    """Beyond the summed terms the tail is bounded from above, closely."""
    df = spark.createDataFrame([(2700, 100_000), (0, 5), (28_900_000, 1_000_000_000)], "k long, n long")
    rows = df.select("k", *[quality_rules.lower_tail(F.col("k"), F.col("n"), 0.03, t).alias(f"t{t}") for t in (100, 10_000)]).collect()
    for r in rows[:2]:
        exact = 0.0
        n = 100_000 if r.k else 5
        for i in range(r.k + 1):
            exact += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.03) + (n - i) * math.log(0.97))
        assert abs(r.t10000 - exact) < 1e-6 * exact and exact <= r.t100 * (1 + 1e-9)
    assert 0 <= rows[2].t10000 < 1e-20


def counts_of(text):
    """The counts of the rules, in plain Python."""
    text = text or ""
    parts = [w for w in WHITE.split(text) if w]
    lines = [x for x in text.split("\n") if WHITE.sub("", x)]
    n, chars, symbols, dup_lines, repeats, _ = plain(text)
    upper = sum(c in quality_rules.UPPER for c in text)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeats,
        "n_lines": len(lines), "n_upper": upper, "n_bangs": text.count("!"), "n_same_words": n - len(set(parts)),
    }


def plain_policies(rows, labels, alpha, delta):
    """{stratum: {rule: cutoff}} by loops over all trials; rows are (doc_id, text, stratum)."""
    quality = {}
    for i, q in labels:
        if i is not None and q is not None:
            quality[i] = max(q, quality.get(i, 0))
    texts = {}
    for i, text, s in rows:
        if i in quality:
            good, first = texts.get((s, text), (0, i))
            texts[s, text] = (max(good, quality[i]), min(first, i))
    tried = [
        (s, q == 1, zlib.crc32(str(i).encode()) % quality_rules.PARTS == 0, counts_of(t)) for (s, t), (q, i) in texts.items()
    ]
    strata = {s for s, *_ in tried}
    tests = (len(strata) + 1) * len(quality_rules.LEVELS)
    need = math.log(delta / tests) / math.log(1 - alpha)
    held = Counter(s for s, good, first, _ in tried if good and not first)
    cell = {s: s if held[s] >= need else "pool" for s in strata}

    def value(rule, c):
        over, under = quality_rules.RULES[rule]
        return c[over] / c[under] if c[under] else 0.0

    def rates(part, rejects):
        n, k = Counter(), Counter()
        for good, c in part:
            n[good] += 1
            k[good] += rejects(c)
        share = lambda g: k[g] / n[g] if n[g] else 0.0
        return n, k, (share(False) - share(True) if k[False] else 0.0)

    chosen = {}
    for name in set(cell.values()):
        mine = [(good, first, c) for s, good, first, c in tried if cell[s] == name]
        first, held_out = ([(g, c) for g, f, c in mine if f is flag] for flag in (True, False))
        best = (0.0, 0, {})
        for level, share in enumerate(quality_rules.LEVELS):
            policy = {}
            for rule in quality_rules.RULES:
                options = []
                for cut in quality_rules.CUTOFFS:
                    n, k, gain = rates(first, lambda c: value(rule, c) > cut)  # noqa: B023
                    if gain > 0 and k[True] <= share * alpha * n[True]:
                        options.append((gain, cut))
                if options:
                    policy[rule] = max(options)[1]
            n, k, gain = rates(held_out, lambda c: any(value(r, c) > cut for r, cut in policy.items()))  # noqa: B023
            tail = sum(math.comb(n[True], i) * alpha**i * (1 - alpha) ** (n[True] - i) for i in range(k[True] + 1))
            if gain > 0 and n[True] and tail <= delta / tests:
                best = max(best, (gain, -level, policy), key=lambda b: b[:2])
        chosen |= {s: best[2] for s in strata if cell[s] == name}
    return chosen


def cuts_of(rows):
    return {r.stratum: {rule: r[f"cut_{rule}"] for rule in quality_rules.RULES if r[f"cut_{rule}"] is not None} for r in rows}


def made(n, bad_of):
    """Documents of one or two strata; every text differs, bad ones are full of symbols."""
    rows, labels = [], []
    for i in range(n):
        bad = bad_of(i)
        words = " ".join(f"w{i}x{j}" for j in range(25))
        # One good document in 150 looks bad too.
        text = words.replace(" ", "#### ") if bad or i % 150 == 1 else words + "!" * (i % 4)
        rows.append((i, text, "en" if i % 5 else "de"))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_policies_against_plain_loops(spark):
    rows, labels = made(1500, lambda i: i % 6 == 0)
    feats = quality_rules.features(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = quality_rules.policies(feats, labels_of(spark, [(*x, "x") for x in labels])).collect()
    expected = plain_policies(rows, labels, quality_rules.ALPHA, quality_rules.DELTA)
    assert cuts_of(got) == {s: p for s, p in expected.items() if p}
    assert expected["en"] and all(r.k_good <= 0.03 * r.n_good and r.p_value <= 0.05 / 12 for r in got)
    # The smaller stratum has too few good documents and no other to be pooled with.
    assert {r.cell for r in got} <= {"s:en", "pool"}


def test_verdicts_of_the_sample(spark):
    """``kept`` of every document of the larger sample, where the policies act, against plain loops."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = [(r.doc_id, r.text or "", r.lang) for r in docs.collect()]
    chosen = plain_policies(rows, [(r.doc_id, r.quality) for r in labels.collect()], quality_rules.ALPHA, quality_rules.DELTA)
    assert any(chosen.values())
    expected = {}
    for i, text, s in rows:
        c = counts_of(text)
        ratios = {rule: c[over] / c[under] if c[under] else 0.0 for rule, (over, under) in quality_rules.RULES.items()}
        expected[i] = not plain(text)[-1] and not any(ratios[r] > cut for r, cut in chosen.get(s, {}).items())
    got = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs, labels).collect()}
    assert got == expected


def test_repeated_rows_and_copies_change_nothing(spark):
    """Each row many times, and each text under many ids, is no more evidence than once."""
    rows, labels = made(240, lambda i: i % 4 == 0)
    once = plain_policies(rows, labels, 0.03, 0.05)
    assert not any(once.values())  # too few
    frame = lambda r: quality_rules.features(spark.createDataFrame(r, "doc_id long, text string, lang string"))
    label = lambda x: labels_of(spark, [(*p, "x") for p in x])
    assert quality_rules.policies(frame(rows * 16), label(labels * 3)).collect() == []
    copies = [(i + 1000 * k, t, s) for i, t, s in rows for k in range(16)]
    copied = [(i + 1000 * k, q) for i, q in labels for k in range(16)]
    assert quality_rules.policies(frame(copies), label(copied)).collect() == []
    # With a wider bound there is a policy, the same one from repeated rows.
    loose = cuts_of(quality_rules.policies(frame(rows), label(labels), 0.2).collect())
    assert loose and loose == cuts_of(quality_rules.policies(frame(rows * 5), label(labels), 0.2).collect())
    assert loose == {s: p for s, p in plain_policies(rows, labels, 0.2, 0.05).items() if p}
