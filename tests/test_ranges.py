"""Changed byte ranges against comparing the files block by block."""

from __future__ import annotations

import random

import pytest
from helpers import values
from pyspark.sql import functions as F

from demandloom.sources import ranges

BLOCK = 64


def plain(old, new, block=BLOCK):
    out = []
    for name in set(old) | set(new):
        a, b = old.get(name), new.get(name)
        x, y = a or b"", b or b""
        if not x and not y and (a is None) != (b is None):
            out.append((name, "added" if a is None else "removed", 0, 0))
        spans = []
        for at in range(0, max(len(x), len(y)), block):
            u, v = x[at : at + block], y[at : at + block]
            if u != v:
                short, long = sorted((len(u), len(v)))
                spans.append(("changed", at, at + short))
                spans.append(("added" if len(v) > len(u) else "removed", at + short, at + long))
        for kind in ("changed", "added", "removed"):
            ends = None
            for _, start, end in sorted(s for s in spans if s[0] == kind and s[1] < s[2]):
                if ends == start:
                    out[-1] = (*out[-1][:3], end)
                else:
                    out.append((name, kind, start, end))
                ends = end
    return sorted(out, key=repr)


def write(folder, files):
    folder.mkdir()
    for name, data in files.items():
        (folder / name).write_bytes(data)
    return str(folder)


def tree(spark, path):
    found = ranges.digest_tree(ranges.block_digests(spark, path, BLOCK))
    return found.withColumn("file_path", F.element_at(F.split("file_path", "/"), -1))


def versions():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice(["ab", "é", "\n", "x y", "\r\n", "\n\n"]) for _ in range(n)).encode()
    old = {f"f{k}": text(60 * k + 5) for k in range(1, 7)}
    old |= {"same": text(3000), "long line": b"z" * 5000, "ended": b"a\n", "gone": b"bye\n", "gone empty": b"", "empty": b"", "mark": b"\xef\xbb\xbf" + text(90)}
    new = dict(old)
    edit = lambda data, at: data[:at] + bytes([data[at] ^ 1 if data[at] not in b"\n\x0b" else data[at]]) + data[at + 1 :]
    new["f2"] = edit(old["f2"], 70)
    new["f3"] = old["f3"] + text(40)
    new["f4"] = old["f4"][:100]
    new["f5"] = b"Q" + old["f5"]
    new["long line"] = b"z" * 700 + b"\n" + b"z" * 4299
    new["ended"] = b"a"
    new["mark"] = old["mark"][3:]
    new["f6"] = b"\xef\xbb\xbf" + old["f6"]
    new["fresh"], new["fresh empty"] = text(50), b""
    del new["gone"], new["gone empty"]
    return old, new


@pytest.mark.parametrize("split", ["97", "134217728"])
def test_against_comparing_bytes(spark, tmp_path, split):
    old, new = versions()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        first, second = (tree(spark, write(tmp_path / name, files)) for name, files in (("old", old), ("new", new)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert first.agg(F.max("level")).first()[0] == 2
    assert values(ranges.diff_ranges(first, second, BLOCK)) == plain(old, new)
    assert values(ranges.diff_ranges(first, first, BLOCK)) == []


def test_only_differing_subtrees_are_followed(spark, tmp_path):
    data = b"0123456789abcde\n" * 4000
    edited = data[:30000] + b"!" + data[30001:]
    first = tree(spark, write(tmp_path / "old", {"one": data, "two": data}))
    second = tree(spark, write(tmp_path / "new", {"one": data, "two": edited}))
    assert values(ranges.changed_blocks(first, second)) == [("two", 30000 // BLOCK, BLOCK, BLOCK)]


def test_empty_folder_and_compressed_files(spark, tmp_path):
    nothing = tree(spark, write(tmp_path / "none", {"empty": b""}))
    some = tree(spark, write(tmp_path / "some", {"one": b"ab\n"}))
    assert values(ranges.diff_ranges(nothing, some, BLOCK)) == [("empty", "removed", 0, 0), ("one", "added", 0, 3)]
    with pytest.raises(ValueError, match="compressed"):
        ranges.block_digests(spark, write(tmp_path / "packed", {"one.gz": b"ab\n"}))
