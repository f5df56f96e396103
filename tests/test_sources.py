from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest
from helpers import values
from pyspark.sql import functions as F

from demandloom import session
from demandloom.operators.clean import coerce_types
from demandloom.schema import BRONZE, RAW_COLUMNS, SEQ, SOURCE_FILE
from demandloom.sources import ledger, listing, manifest, readers, writers

ROW = ("2024-01-01", "1.5", "2", "T1", " Downtown ", "milk", "7")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([ROW, (None,) * 7], BRONZE)
    path = str(tmp_path / f"out.{fmt}")
    writers.write_table(df, path)
    writers.write_table(df, path)
    back = readers.read_files(spark, path, "jsonl" if fmt == "json" else None)
    assert values(back) == values(df)


def test_json_array_and_column_order(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([dict(zip(RAW_COLUMNS, ROW)), {"Quantity": "5", "Extra": 1}]))
    back = readers.read_files(spark, str(path))
    assert back.columns == RAW_COLUMNS
    assert sorted(r.Quantity for r in back.collect()) == ["2", "5"]
    csv = tmp_path / "b.csv"
    csv.write_text("Extra,Quantity,Date\nx,5,2024-01-01\n")
    assert values(readers.read_csv_by_name(spark, str(csv))) == [("2024-01-01", "5")]


def test_unknown_formats(spark):
    for name in ("x.xlsx", "x.txt", "x"):
        with pytest.raises(ValueError, match="Unsupported file type"):
            readers.read_files(spark, name)
        with pytest.raises(ValueError, match="Unsupported file type"):
            writers.write_table(spark.range(1), name)
    assert readers.file_format("A/B.CSV") == "csv"


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError, match="no rows"):
        readers.require_rows(spark.createDataFrame([], BRONZE))


def test_row_order_columns(spark, tmp_path):
    path = tmp_path / "a b.csv"
    path.write_text(",".join(RAW_COLUMNS) + "\n" + "".join(f"2024-01-01,1,{i},T{i},s,milk,1\n" for i in range(500)))
    rows = readers.with_row_order(readers.read_files(spark, str(path))).orderBy("row_block", SEQ).collect()
    assert [r.Quantity for r in rows] == [str(i) for i in range(500)]
    assert {r[SOURCE_FILE] for r in rows} == {f"file:{path}"}


def test_query_source(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    assert values(readers.read_query(spark, "select max(id) m from numbers")) == [(2,)]


def test_same_result_in_two_places(spark, tmp_path):
    targets = [str(tmp_path / "main.csv"), str(tmp_path / "cache.csv")]
    writers.write_everywhere(spark.createDataFrame([ROW], BRONZE), targets)
    assert all(spark.read.option("header", True).csv(t).count() == 1 for t in targets)


def test_per_source_partitions_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "daily")

    def write(rows):
        writers.write_per_source(spark.createDataFrame(rows, f"{SOURCE_FILE} string, n int"), path)

    write([("in/Some File.csv", 1), ("in/b.csv", 2), ("other/b.csv", 3), ("in/Some_File.csv", 4)])
    write([("in/b.csv", 5), ("in/b.csv", 6)])
    assert values(spark.read.parquet(path), "output_name", "n") == [
        ("processed_Some_File.csv", 1), ("processed_Some_File.csv", 4), ("processed_b.csv", 3), ("processed_b.csv", 5), ("processed_b.csv", 6)]
    # A processed file without a row left loses what it had; others keep theirs.
    files = spark.createDataFrame([("in/b.csv",), ("in/Some File.csv",)], "file_path string")
    writers.write_per_source(spark.createDataFrame([("in/Some File.csv", 8)], f"{SOURCE_FILE} string, n int"), path, files)
    assert values(spark.read.parquet(path), SOURCE_FILE, "n") == [("in/Some File.csv", 8), ("in/Some_File.csv", 4), ("other/b.csv", 3)]


def test_listing_and_ledger(spark, tmp_path):
    inbox = tmp_path / "in"
    (inbox / "sub").mkdir(parents=True)
    for name in ("b.csv", "a.csv", "empty.csv", "_SUCCESS"):
        (inbox / name).write_text("" if name == "empty.csv" else "x")
    listed = listing.list_files(spark, str(inbox))
    names = [r.file_path.rsplit("/", 1)[-1] for r in listing.first_files(listed).collect()]
    assert names == ["a.csv", "b.csv", "empty.csv"]
    assert listing.first_files(listed, 1).count() == 1
    assert listing.list_files(spark, str(tmp_path / "absent")).isEmpty()
    book = str(tmp_path / "ledger")
    assert ledger.unprocessed(listed, ledger.read_ledger(spark, book)).count() == 3
    ledger.record(listed.where("file_path like '%a.csv'"), book)
    (inbox / "c.csv").write_text("y")
    again = ledger.unprocessed(listing.list_files(spark, str(inbox)), ledger.read_ledger(spark, book))
    names = sorted(r.file_path.rsplit("/", 1)[-1] for r in again.collect())
    assert names == ["b.csv", "c.csv", "empty.csv"]
    assert ledger.delete_sources(spark, [f"file:{inbox}/c.csv"]) == 1
    assert not (inbox / "c.csv").exists()


def test_versions(spark, tmp_path):
    data, log = tmp_path / "data", str(tmp_path / "log")
    data.mkdir()
    (data / "a.csv").write_text("1")
    (data / "b.csv").write_text("2")
    first = session.stage(listing.inventory(spark, str(data)))
    manifest.append_version(first.limit(0), log, datetime(2025, 1, 1))
    manifest.append_version(first, log, datetime(2025, 3, 15, 12))
    (data / "a.csv").write_text("changed")
    (data / "c.csv").write_text("3")
    second = listing.inventory(spark, str(data)).where("file_path not like '%b.csv'")
    documents = manifest.version_documents(manifest.read_manifest(spark, log)).orderBy("version_ts", "file_path").collect()
    parsed = [json.loads(d.document) for d in documents]
    assert [p["timestamp"] for p in parsed] == ["2025-01-01T00:00:00", *["2025-03-15T12:00:00"] * 2]
    assert "file" not in parsed[0] and [p["file"]["file_path"][-5:] for p in parsed[1:]] == ["a.csv", "b.csv"]
    changes = {r.file_path[-5:]: r.change for r in manifest.diff_versions(first, second).collect()}
    assert changes == {"a.csv": "changed", "b.csv": "removed", "c.csv": "added"}
    assert manifest.read_manifest(spark, str(tmp_path / "none")).isEmpty()
    assert manifest.versioning_succeeded(first, first).first().success
    assert manifest.versioning_succeeded(first.limit(0), first.limit(0)).first().success
    assert not manifest.versioning_succeeded(first, first.limit(0)).first().success


def test_corrupt_version_log_starts_anew(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.warns(UserWarning, match="starts anew"):
        assert manifest.read_manifest(spark, str(log)).isEmpty()


@pytest.mark.parametrize("block", ["128m", "64b"])
def test_digest_sees_order_and_line_ends_at_any_size(spark, tmp_path, block):
    lines = [f"line {i % 5} {'x' * (i % 9)}" for i in range(40)]
    swapped = [*lines[:10], lines[11], lines[10], *lines[12:]]
    texts = {"a": "\n".join(lines), "b": "\n".join(lines) + "\n", "c": "\r\n".join(lines), "d": "\n".join(swapped), "e": "\n".join(lines), "f": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = {r.file_path[-1]: r.digest for r in listing.inventory(spark, str(tmp_path)).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

    def plain(text):
        parts = text.split("\n")[: -1 if text.endswith("\n") or not text else None]
        hexes = [hashlib.md5(f"{i}:{x}".encode()).hexdigest() for i, x in enumerate(parts, 1)]
        sums = [str(sum(int(h[k : k + 15], 16) for h in hexes)) for k in (0, 15)]
        return "-".join([str(len(text)), str(len(parts)), *sums] if parts else [str(len(text)), "0"])

    assert found == {k: plain(t) for k, t in texts.items()}
    assert found["a"] == found["e"] and len(set(found.values())) == 5


def test_content_digest_ignores_order(spark):
    df = spark.range(100).selectExpr("id % 3 k", "id v")
    one = listing.content_digest(df.repartition(7), ["k"])
    assert values(one) == values(listing.content_digest(df.orderBy("v", ascending=False), ["k"]))
    assert values(one) != values(listing.content_digest(df.selectExpr("k", "v + 1 v"), ["k"]))


def test_staging_needs_a_shared_folder(spark, monkeypatch):
    assert session.staging_root(spark) == spark.conf.get("spark.checkpoint.dir")

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_root(Cluster)


def test_staged_table_keeps_names_and_types(spark):
    typed = coerce_types(spark.createDataFrame([ROW], BRONZE))
    staged = session.stage(typed)
    assert staged.schema == typed.schema
    assert values(staged) == values(typed)


def test_repeated_texts_are_not_broadcast_by_their_size_on_disk(spark):
    """A table of a megabyte or two on disk and over a hundred in memory."""
    wide = session.stage(spark.range(300_000).select("id", F.lit("x" * 400).alias("text")), "wide")
    joined = spark.range(3_000_000).selectExpr("id", "id % 7 as k").join(wide, "id")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 300_000


def test_many_files_are_listed_by_few_tasks(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"f{k}.txt").write_text(f"{k}\n")
    paths, context = [str(p) for p in tmp_path.glob("*.txt")], spark.sparkContext
    context.setJobGroup("listing", "listing")
    lines = spark.read.text(paths)
    context.setJobGroup("reading", "reading")
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert tasks and max(tasks) <= 32
    assert sorted(int(r.value) for r in lines.collect()) == list(range(40))


def test_local_listing_starts_no_process_for_a_file(spark, tmp_path, monkeypatch):
    """Nested and empty files are there, hidden ones are not; a file is a listing of itself."""
    (tmp_path / "a" / "b").mkdir(parents=True)
    for name, text in (("a/one.csv", "1"), ("a/b/two.csv", ""), ("a/_done", "x"), ("a/.hid", "x"), ("three.csv", "123")):
        (tmp_path / name).write_text(text)
    found = {r.file_path.split(tmp_path.name)[1]: r["size"] for r in listing.list_files(spark, str(tmp_path)).collect()}
    assert found == {"/a/one.csv": 1, "/a/b/two.csv": 0, "/three.csv": 3}
    assert [r["size"] for r in listing.list_files(spark, str(tmp_path / "three.csv")).collect()] == [3]
    assert listing.list_files(spark, str(tmp_path / "none")).count() == 0

    class Located:
        """Fails where the files of a local folder are asked for with their locations."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            assert name != "listFiles"
            return getattr(self.fs, name)

    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(tmp_path))
    fs = Located(root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()))
    assert len(list(listing._found_files(fs, root))) == 5


def test_ranges_and_shuffles_keep_their_size(spark, tmp_path):
    """What one task reads does not grow with the file, nor with the table behind a shuffle."""
    (tmp_path / "large.csv").write_text(("x" * 999 + "\n") * 70_000)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        lines = readers.read_lines(spark, str(tmp_path / "large.csv"))
        assert lines.select("block_start").distinct().count() == 3
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    text = F.concat(*[F.md5(F.concat("id", F.lit(str(k))).cast("string")) for k in range(10)])
    spread = spark.range(200_000).select("id", text.alias("text")).groupBy("id").agg(F.max("text").alias("text"))
    # 70 MB behind a shuffle that the session would cut in two.
    assert spread.rdd.getNumPartitions() >= 4
