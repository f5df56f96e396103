"""JSON documents against the json module of Python, at every size of block."""

from __future__ import annotations

import json
import random

import pytest

from demandloom.sources import documents

TEXTS = ["", "plain", 'a "quote"', "}, {", "[{", "back\\", '\\"', "é\n日本", "a,b", '{"x": 1}', "\\\\", "]"]
COLUMNS = ["A", "B b", "C"]


@pytest.fixture
def blocks(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def text(value):
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def made(rng, n):
    nested = [{"k": ["}", {"z": 1}]}, [1, {"q": "]"}], True, 12, None]
    return [{"A": f"r{i}", "B b": rng.choice(TEXTS), **({"C": rng.choice(nested + TEXTS)} if rng.random() < 0.8 else {}), "X": rng.choice(TEXTS)} for i in range(n)]


def found(df):
    return [[r[c] for c in COLUMNS] for r in df.orderBy("source_file", "row_block", "row_seq").collect()]


def expected(rows):
    return [[text(r.get(c)) for c in COLUMNS] for r in rows]


def by_column(rows):
    names = list(dict.fromkeys(k for r in rows for k in r))
    return {n: {str(i): r[n] for i, r in enumerate(rows) if n in r} for n in names}


@pytest.mark.parametrize("size, indent", [("17", None), ("60", 2), ("64m", None), ("64m", 1)])
def test_arrays_at_any_block_size(spark, blocks, tmp_path, size, indent):
    rows = made(random.Random(size), 2 if size == "17" else 9)
    (tmp_path / "f.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=indent is None), encoding="utf-8")
    blocks(size)
    assert found(documents.read_json_array(spark, str(tmp_path / "f.json"), COLUMNS)) == expected(rows)


@pytest.mark.parametrize("size, indent", [("17", None), ("60", 2), ("64m", None), ("64m", 1)])
def test_columns_at_any_block_size(spark, blocks, tmp_path, size, indent):
    rows = made(random.Random(size), 2 if size == "17" else 9)
    (tmp_path / "f.json").write_text(json.dumps(by_column(rows), indent=indent, ensure_ascii=indent is None), encoding="utf-8")
    blocks(size)
    assert found(documents.read_json_columns(spark, str(tmp_path / "f.json"), COLUMNS)) == expected(rows)


def test_either_kind_and_broken_files(spark, blocks, tmp_path):
    flat = [{"A": "1", "B b": "x", "C": "y"}, {"A": "2", "B b": "}", "C": ","}]
    contents = {
        "list": json.dumps(flat), "frame": json.dumps(by_column(flat)), "none": "[ ]", "bare": "{}",
        "hollow": '{"A": {}, "C": {}}', "cut": json.dumps(flat)[:-1], "half": json.dumps(flat)[:-9],
        "comma": json.dumps(flat).replace("}, {", "} {"), "after": json.dumps(flat) + " 5", "scalars": "[1, 2]", "pairs": "[[1], [2]]",
        "cutframe": json.dumps(by_column(flat))[:-1], "halfframe": json.dumps(by_column(flat))[:-12],
        "flatframe": '{"A": "1"}', "badvalue": '[{"A": tru}]', "badcell": '{"A": {"0": tru}}', "blank": " \n",
    }
    for name, content in contents.items():
        (tmp_path / f"{name}.json").write_text(content)
    for size in ("40", "64m"):
        blocks(size)
        rows, verdicts = documents.document_rows(spark, [str(tmp_path)], COLUMNS)
        got = {r.file_path.split("/")[-1][:-5]: (r.rows, sorted(r.has), r.broken) for r in verdicts.collect()}
        sound = {n: v[:2] for n, v in got.items() if not v[2]}
        assert sound == {"list": (2, COLUMNS), "frame": (2, COLUMNS), "none": (0, []), "bare": (0, []), "hollow": (0, ["A", "C"])}
        assert set(got) == set(contents)
        good = rows.where("source_file like '%/list.json' or source_file like '%/frame.json'")
        assert found(good) == expected(flat) * 2
    with pytest.raises(ValueError):
        documents.read_json_array(spark, str(tmp_path / "cut.json"), COLUMNS)


def test_repeated_names_and_keys(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"A": 1, "A": 2.50}]')
    (tmp_path / "c.json").write_text('{"A": {"7": 1, "x": 2, "7": 3}, "C": {"x": null, "new": "n"}}')
    assert found(documents.read_json_array(spark, str(tmp_path / "a.json"), COLUMNS)) == [["2.5", None, None]]
    got = found(documents.read_json_columns(spark, str(tmp_path / "c.json"), COLUMNS))
    assert got == [["3", None, None], ["2", None, None], [None, None, "n"]]
