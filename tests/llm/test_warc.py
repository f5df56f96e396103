"""Archives: round trips over small blocks, and magic inside payloads."""

from __future__ import annotations

import base64
import hashlib

import pytest

from demandloom.llm import warc

SCHEMA = "page_id long, url string, html string, start long, file string, digest string"
RECORD = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x", "y") for i, u, h in rows], SCHEMA)


def plain(rows):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        to = first.get(h or "")
        again = to is not None and i != to
        out.append((i, len((h or "").encode()), digest(h), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/", "<p>eins</p>"), (2, "http://b/\r\nX: y", "<p>eins</p>"), (3, None, None), (4, "u", ""), (5, "u", RECORD), (6, "u", f"é🤖{RECORD * 3}tail"),
    (7, "u", "WARC/1.1\r\n"), (8, "u", "WARC/1.1\r\nContent-Length: 999999999999\r\n\r\n"), (9, "u", "x\r\n\r\n"), (9, "u", "x\r\n\r\n"), (None, "u", "<p>eins</p>"),
    (None, "u", "alone"), (10, "u", "long " * 60_000), (11, "u", RECORD), (-5, "u", "minus"),
]


@pytest.mark.parametrize("block", ["128m", "3k", "200b"])
def test_round_trip(spark, block):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    rows = ROWS + [(100 + i, f"http://x/{i}", f"<p>{i % 7}</p>" + "z" * (i % 50)) for i in range(60)]
    if block == "200b":  # thousands of blocks
        rows = [r for r in rows if r[0] != 10]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = warc.archive_report(pages_of(spark, rows).coalesce(2)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_payloads_and_threshold(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(pages_of(spark, ROWS), path, least=20)
    found = warc.read_archives(spark, path).collect()
    texts = sorted(bytes(r.payload).decode() for r in found if r.type == "response")
    # Payloads under 20 bytes are written each time.
    assert texts.count("<p>eins</p>") == 3 and texts.count(RECORD) == 1
    assert sum(r.type == "revisit" for r in found) == 1
    for r in found:
        if r.type == "response":
            assert r.digest == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()


def test_empty_table(spark):
    assert warc.archive_report(pages_of(spark, ROWS).limit(0)).count() == 0


def test_files_cut_elsewhere_between_reads(spark, monkeypatch):
    """Blocks that change during the query, as when executors come or go."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old, plan = {k: spark.conf.get(k) for k in keys}, warc.reachable
    rows = ROWS + [(100 + i, f"http://x/{i}", f"<p>{i}</p>" + "z" * (i % 50)) for i in range(60)]

    def reachable(placed):
        found = warc.stage(plan(placed), "test-records")
        spark.conf.set(keys[0], "3k")
        return found

    monkeypatch.setattr(warc, "reachable", reachable)
    try:
        spark.conf.set(keys[0], "128m")
        spark.conf.set(keys[1], "1")
        got = warc.archive_report(pages_of(spark, rows).coalesce(2)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_lost_records_are_an_error(spark, monkeypatch):
    read = warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda *args: read(*args).filter("record_id <> '<urn:page:5>'"))
    with pytest.raises(RuntimeError, match="read back"):
        warc.archive_report(pages_of(spark, ROWS))
