"""Quoted records against the csv module of Python, at every size of block."""

from __future__ import annotations

import csv
import random

import pytest

from demandloom.operators import validate
from demandloom.plans import retail
from demandloom.schema import RAW_COLUMNS
from demandloom.sources import readers, records
from demandloom.sources.ledger import read_ledger

PARTS = ["", "plain", 'a "quote"', "line\nbreak", 'two\n\nlines, "and" quotes', ",", "\n", '"', " pad ", "é\n日本\n\n"]


@pytest.fixture
def blocks(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows(rows)


def made(rng, n):
    return [[f"d{i}", rng.choice(PARTS), rng.choice(PARTS)] for i in range(n)]


@pytest.mark.parametrize("size", ["1", "11", "64m"])
def test_records_at_any_block_size(spark, blocks, tmp_path, size):
    rows = made(random.Random(3), 6)
    write(tmp_path / "f.csv", [["A", "B", "C"], *rows])
    blocks(size)
    got = readers.read_csv_records(spark, str(tmp_path / "f.csv"), ["C", "A", "B"])
    got = got.orderBy("row_block", "row_seq").select("A", "B", "C").collect()
    assert [list(r) for r in got] == [[c or None for c in r] for r in rows]


def test_many_files_and_other_line_ends(spark, blocks, tmp_path):
    rng, wanted = random.Random(4), {}
    for k in range(6):
        rows = made(rng, rng.randint(0, 40))
        wanted[f"f{k}.csv"] = [[c or None for c in r] for r in rows]
        write(tmp_path / f"f{k}.csv", [["A", "B", "C"], *rows], "\r\n" if k % 2 else "\n")
    blocks("900")
    got = readers.read_csv_records(spark, str(tmp_path), ["A", "B", "C"]).orderBy("row_block", "row_seq").collect()
    for name, rows in wanted.items():
        assert [[r.A, r.B, r.C] for r in got if r.source_file.endswith(name)] == rows


def test_states_against_a_scan(spark):
    """Random lines of quotes, commas and letters: the state after every line, by a character loop."""
    rng = random.Random(5)
    text = ["".join(rng.choice('a,"" ') for _ in range(rng.randint(0, 6))) for _ in range(120)]
    frame = spark.createDataFrame([("f", i // 7, i, t) for i, t in enumerate(text)], "file_path string, block_start long, line_no long, value string")
    got = {r.line_no: r for r in records.line_states(frame).collect()}
    inside, begun = False, None
    for i, line in enumerate(text):
        assert got[i].inside == inside
        if not inside:
            begun = i
        at, state = 0, "quoted" if inside else "start"
        while at < len(line):
            c = line[at]
            if state == "quoted":
                if c == '"':
                    if line[at + 1 : at + 2] == '"':
                        at += 1
                    else:
                        state = "rest"
            elif c == ",":
                state = "start"
            elif state == "start" and c == '"':
                state = "quoted"
            else:
                state = "rest"
            at += 1
        inside = state == "quoted"
        assert got[i].ends == inside
        assert (got[i].at_block, got[i].at_line) == (begun // 7, begun)
    assert {r.open for r in got.values()} == {inside}


def test_edges(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        (tmp_path / "empty.csv").write_text("")
        readers.read_csv_records(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "x.csv").write_text("\n\nA,B\n\n1,\"x\ny\"\n\nA,B\n")
    got = readers.read_csv_records(spark, str(tmp_path / "x.csv"), ["A", "B"]).orderBy("row_block", "row_seq").collect()
    # Blank lines are no records; a row like the header is a row.
    assert [(r.A, r.B) for r in got] == [("1", "x\ny"), ("A", "B")]
    (tmp_path / "y.csv").write_text("C,D\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        readers.read_csv_records(spark, [str(tmp_path / "x.csv"), str(tmp_path / "y.csv")], ["A"])


def transactions(n, store):
    return [[f"2024-01-{1 + i % 28:02d} 10:00:00", "2.5", "3", f"T{i}", store(i), "milk", "7"] for i in range(n)]


def test_folder_job_takes_quoted_line_breaks(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    plain = transactions(40, lambda i: f"Store {i}")
    odd = transactions(40, lambda i: f'St "{i}",\nfloor\n\n2' if i % 2 else "St")
    write(inbox / "plain.csv", [RAW_COLUMNS, *plain])
    # Its own column order, and a header that is quoted too.
    order = [6, 0, 4, 2, 1, 3, 5]
    write(inbox / "odd.csv", [[f"{RAW_COLUMNS[k]}" for k in order], *[[r[k] for k in order] for r in odd]])
    (inbox / "open.csv").write_text(",".join(RAW_COLUMNS) + '\n2024-01-01,1,1,T1,"never closed,milk,7\n2024-01-01,1,1,T2,x,milk,7\n')
    (inbox / "missing.csv").write_text('Date,Quantity\n2024-01-01,"1\n2"\n')
    verdicts, status = retail.pre_validate(spark, str(inbox))
    found = {r.file_path.rsplit("/", 1)[1]: (r.rows, r.valid, r.error) for r in verdicts.collect()}
    assert found["plain.csv"] == (40, True, None) and found["odd.csv"] == (40, True, None)
    assert found["open.csv"][1:] == (False, validate.OPEN_QUOTE_MESSAGE)
    assert found["missing.csv"][0] == 1 and found["missing.csv"][2].startswith(validate.MISSING_MESSAGE)
    assert status.first().status == validate.SOME_VALID
    done, book = str(tmp_path / "out"), str(tmp_path / "book")
    assert retail.process_folder(spark, str(inbox), done, book) == validate.SOME_VALID
    daily = spark.read.parquet(done)
    totals = [r[0] for r in daily.groupBy("source_key" if "source_key" in daily.columns else daily.columns[-1]).sum("Total Quantity").select("sum(Total Quantity)").collect()]
    assert sorted(totals) == [120, 120]
    errors = {r.file_path.rsplit("/", 1)[1]: r.error for r in read_ledger(spark, book).collect()}
    assert errors["odd.csv"] is None and errors["open.csv"] == validate.OPEN_QUOTE_MESSAGE
