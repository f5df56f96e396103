"""Line de-duplication against a plain statement of the rule."""

from __future__ import annotations

import random

from demandloom.llm import line_dedup


def plain(pairs, size=3):
    """Pairs as (doc_id, text) in, texts out in the same order."""
    order = sorted(range(len(pairs)), key=lambda k: (pairs[k][0] is None, pairs[k][0] or 0))
    seen, cover = {}, {k: set() for k in order}
    for k in order:
        lines = (pairs[k][1] or "").split("\n") if pairs[k][1] is not None else []
        full = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        for at in zip(*(full[d:] for d in range(size))):
            window = tuple(lines[i] for i in at)
            if seen.setdefault(window, (pairs[k], at)) != (pairs[k], at):
                cover[k].update(range(at[0], at[-1] + 1))
    return [None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cover[k]) for k, (_, t) in enumerate(pairs)]


def check(docs):
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.doc_id, r.text) for r in line_dedup.remove_repeated_lines(docs).collect()), key=repr)
    assert got == sorted(((i, t) for (i, _), t in zip(pairs, plain(pairs))), key=repr)


def test_random_lines(make_docs):
    rng = random.Random(3)
    check(make_docs([(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "d e"]) for _ in range(rng.randint(0, 14)))) for i in range(60)]))


def test_edge_cases(edge_docs):
    check(edge_docs)
    done = line_dedup.remove_repeated_lines(edge_docs, counts=True)
    assert done.columns == [*edge_docs.columns, "n_lines", "n_removed"]
    assert line_dedup.remove_repeated_lines(edge_docs.limit(0)).count() == 0


def test_n_chars_follows_the_text(spark):
    text = "a a\nb b\nc c"
    docs = spark.createDataFrame([(1, text, 11), (2, text + "\nend", 15), (3, None, None)], "doc_id long, text string, n_chars int")
    rows = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.remove_repeated_lines(docs).collect()}
    assert rows == {1: (text, 11), 2: ("end", 3), 3: (None, None)}


def test_hot_window(make_docs, no_broadcast):
    check(make_docs([(i, f"head {i}\nx\ny\nz\ntail {i}") for i in range(400)]))
