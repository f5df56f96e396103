"""Whole jobs, un-mocked: batch, folder and stream."""

from __future__ import annotations

import os
import random
from datetime import date, datetime, timedelta

import pytest
from helpers import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.operators.anomalies import KINDS
from demandloom.plans import retail
from demandloom.schema import BRONZE, DATE, PRODUCT, RAW_COLUMNS, SEQ, SOURCE_FILE, TOTAL, TX_ID
from demandloom.streaming import ingest

PRODUCTS = ["milk", "coffee", "beef"]


def transactions(seed, n, day=datetime(2024, 3, 4, 8)):
    """Messy text rows in ascending order of time."""
    rng = random.Random(seed)
    rows, now = [], day
    for i in range(n):
        now += timedelta(minutes=rng.randrange(1, 25))
        stamp = now.strftime("%Y-%m-%d %H:%M:%S")
        if i % 17 == 3:
            stamp = None
        elif i % 41 == 5:
            stamp = now.strftime("%d/%m/%Y")
        name = rng.choice(PRODUCTS)
        name = {0: f"  {name.upper()} ", 1: "m@lk"}.get(i % 13, name)
        quantity = rng.choice(["1", "2", "3.0", "4"])
        quantity = {7: None, 8: "0", 9: "900"}.get(i % 53, quantity)
        price = None if i % 10 == 4 else rng.choice(["1.5", "2.0", "2.0"])
        tx = f"T{i - 1 if i % 29 == 9 else i}"
        rows.append((stamp, price, quantity, tx, "Downtown", name, "1"))
    return rows


def write_csv(path, rows, header=RAW_COLUMNS):
    lines = [",".join("" if v is None else v for v in r) for r in rows]
    path.write_text("\n".join([",".join(header), *lines]) + "\n")


def plain_job(rows):
    """The job for one file in plain Python; returns {(day, product): quantity}."""

    def parse(text):
        for shape in ("%Y-%m-%d %H:%M:%S", "%d/%m/%Y"):
            try:
                return datetime.strptime(text or "", shape)
            except ValueError:
                pass
        return None

    dates = [parse(r[0]) for r in rows]
    known = [(i, d) for i, d in enumerate(dates) if d]
    days = [d.date() for _, d in known]
    ascending = all(a <= b for a, b in zip(days, days[1:]))
    table = []
    for i, r in enumerate(rows):
        when = dates[i]
        if when is None:
            before, after = [k for k in known if k[0] < i], [k for k in known if k[0] > i]
            if not (ascending and before and after and before[-1][1].date() == after[0][1].date()):
                continue
            (pi, p), (ni, n) = before[-1], after[0]
            micros = (n - p) // timedelta(microseconds=1) * (i - pi)
            when = p + timedelta(microseconds=int(micros / (ni - pi)))
        name = r[5].strip().lower()
        if name in PRODUCTS:
            quantity = None if r[2] is None else round(float(r[2]))
            table.append([when, float(r[1]) if r[1] else None, quantity, r[3].lower(), name])

    def mode(keys):
        counts = {}
        for when, price, _, _, name in table:
            if price is not None:
                slot = counts.setdefault(keys(when, name), {})
                slot[price] = slot.get(price, 0) + 1
        return {k: min(v, key=lambda p: (-v[p], p)) for k, v in counts.items()}

    levels = [
        lambda w, n: (w.year, w.month, w.isocalendar()[1], n),
        lambda w, n: (w.year, w.month, n),
        lambda w, n: (w.year, n),
    ]
    modes = [(level, mode(level)) for level in levels]
    for row in table:
        if row[1] is None:
            row[1] = next((m[k(row[0], row[4])] for k, m in modes if k(row[0], row[4]) in m), 0.0)
    seen, unique = set(), []
    for row in table:
        if row[2] is not None and row[3] not in seen:
            seen.add(row[3])
            unique.append(row)

    def limits(xs):
        xs = sorted(xs)

        def at(p):
            place = (len(xs) - 1) * p
            low = int(place)
            return xs[low] + (xs[min(low + 1, len(xs) - 1)] - xs[low]) * (place - low)

        q1, q3 = at(0.25), at(0.75)
        if q1 == q3:
            return q1, q3
        low = q1 - 1.5 * (q3 - q1)
        return (max(0, low) if xs[0] >= 0 else low), q3 + 2.0 * (q3 - q1)

    groups = {}
    for row in unique:
        groups.setdefault((row[0].date(), row[4]), []).append(row)
    result = {}
    for key, group in groups.items():
        bad = set()
        for column in (1, 2):
            if len(group) >= 4:
                low, high = limits([g[column] for g in group])
                bad |= {g[3] for g in group if not low <= g[column] <= high}
        bad |= {g[3] for g in group if g[0].hour < 6 or g[0].hour > 22 or g[2] <= 0}
        kept = [g[2] for g in group if g[3] not in bad]
        if kept:
            result[key] = sum(kept)
    return result


def daily_of(df, source):
    rows = df.where(df[SOURCE_FILE].endswith(source)).select(DATE, PRODUCT, TOTAL).collect()
    return {(r[0], r[1]): r[2] for r in rows}


@pytest.fixture(scope="module")
def files():
    return {"a.csv": transactions(1, 400), "b c.csv": transactions(2, 300)}


def bronze(spark, files):
    rows = [(*r, name, i) for name, table in files.items() for i, r in enumerate(table)]
    schema = T.StructType([*BRONZE.fields, T.StructField(SOURCE_FILE, T.StringType()), T.StructField(SEQ, T.LongType())])
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(("rows_per_block", "partitions"), [(37, 5), (100_000, 1)])
def test_batch_against_plain_python(spark, files, rows_per_block, partitions):
    raw = bronze(spark, files).repartition(partitions)
    result = retail.run_batch(raw, rows_per_block=rows_per_block)
    for name, rows in files.items():
        assert daily_of(result.daily, name) == plain_job(rows)
    passed, failures, stats = retail.post_validate(result.daily)
    assert passed and failures.isEmpty() and stats.count() == len(PRODUCTS)
    assert result.stats().count() == len(PRODUCTS) * len(files)
    assert result.summary().first().error_count == 0


def test_batch_invariants(spark, files):
    result = retail.run_batch(bronze(spark, files))
    ids = {(r[0], r[1]) for r in result.flagged.select(SOURCE_FILE, TX_ID).collect()}
    clean = {(r[0], r[1]) for r in result.clean.select(SOURCE_FILE, TX_ID).collect()}
    bad = {(r[0], r[1]) for r in result.anomalies.select(SOURCE_FILE, TX_ID).collect()}
    assert clean | bad == ids and not clean & bad
    assert sum(r[0] for r in result.daily.select(TOTAL).collect()) == sum(
        r[0] for r in result.clean.select("Quantity").collect()
    )
    assert set(KINDS) >= {r[0] for r in result.anomalies.select("anomaly_type").distinct().collect()}


def test_batch_without_broadcast(no_broadcast, files):
    result = retail.run_batch(bronze(no_broadcast, files))
    assert daily_of(result.daily, "a.csv") == plain_job(files["a.csv"])


def test_all_rows_as_one_batch(spark, files):
    """Without per-file separation an ID that both files use counts once."""
    result = retail.run_batch(bronze(spark, files), per_file=False)
    ids = [r[0] for r in result.flagged.select(TX_ID).collect()]
    assert len(ids) == len(set(ids))
    assert result.daily.columns == [DATE, PRODUCT, TOTAL]


def inbox_of(tmp_path, files):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for name, rows in files.items():
        write_csv(inbox / name, rows)
    return inbox


def test_folder_job(spark, tmp_path, files):
    inbox = inbox_of(tmp_path, files)
    (inbox / "broken.csv").write_text("Date,Quantity\n2024-01-01,1\n")
    shuffled = [1, 0, *range(2, 7)]
    order = [RAW_COLUMNS[i] for i in shuffled]
    write_csv(inbox / "swapped.csv", [[r[i] for i in shuffled] for r in files["a.csv"]], order)
    output, cache, book = (str(tmp_path / n) for n in ("out", "cache", "ledger"))
    reports = str(tmp_path / "reports")
    assert retail.process_folder(spark, str(inbox), output, book, cache, reports=reports) == 1
    assert spark.read.parquet(f"{reports}/anomalies").count() > 0
    assert spark.read.parquet(f"{reports}/stats").count() == 3 * len(PRODUCTS)
    for place in (output, cache):
        published = spark.read.parquet(place)
        assert daily_of(published, "/a.csv") == plain_job(files["a.csv"])
        assert daily_of(published, "b c.csv") == plain_job(files["b c.csv"])
        assert daily_of(published, "swapped.csv") == plain_job(files["a.csv"])
    names = {r[0] for r in spark.read.parquet(output).select("output_name").distinct().collect()}
    assert names == {"processed_a.csv", "processed_b_c.csv", "processed_swapped.csv"}
    # Nothing is read again, the invalid file neither; the ledger has the reason.
    assert retail.process_folder(spark, str(inbox), output, book) == 2
    assert values(spark.read.parquet(book).where("error is not null"), "error") == [
        ("Missing columns: Unit Price, Transaction ID, Store Location, Product Name, Producer ID",)]
    assert (inbox / "a.csv").exists()
    assert retail.process_folder(spark, str(tmp_path / "nowhere"), output, book) == 2
    verdicts, status = retail.pre_validate(spark, str(inbox))
    assert values(status) == [(4, 3, 1)]


def test_bad_cells_stop_only_their_file(spark, tmp_path, files):
    inbox = inbox_of(tmp_path, files)
    bad = [list(r) for r in files["a.csv"]]
    bad[3][RAW_COLUMNS.index("Quantity")] = "a dozen"
    write_csv(inbox / "bad.csv", bad)
    output, book = str(tmp_path / "out"), str(tmp_path / "ledger")
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    assert retail.process_folder(spark, str(inbox), output, book) == 1
    # The job's intermediate tables are gone.
    assert set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == before
    for name, rows in files.items():
        assert daily_of(spark.read.parquet(output), name) == plain_job(rows)
    assert values(spark.read.parquet(book).where("error is not null"), "error") == [("Bad value in Quantity",)]
    verdicts = str(tmp_path / "verdicts")
    job = ingest.clean_arriving_files(ingest.stream_files(spark, str(inbox)), str(tmp_path / "s"), str(tmp_path / "state"), verdicts, once=True)
    job.awaitTermination()
    assert values(spark.read.parquet(verdicts).where("not valid"), "error") == [("Bad value in Quantity",)]
    assert spark.read.parquet(str(tmp_path / "s")).count() == spark.read.parquet(output).count()


def test_delivery_again_replaces_only_its_own_file(spark, tmp_path, files):
    inbox = tmp_path / "inbox"
    for folder in ("p", "q"):
        (inbox / folder).mkdir(parents=True)
        write_csv(inbox / folder / "same.csv", files["a.csv"])
    output, book, reports = (str(tmp_path / n) for n in ("out", "ledger", "reports"))
    assert retail.process_folder(spark, str(inbox), output, book, reports=reports) == 0
    flagged = lambda folder: spark.read.parquet(f"{reports}/anomalies").where(F.contains(SOURCE_FILE, F.lit(f"/{folder}/"))).count()
    was = flagged("p")
    assert was > 0 and flagged("q") == was
    # The same path again, with one plain row: no anomaly is left of it.
    row = list(files["a.csv"][0])
    for column, value in ((DATE, "2024-05-06 12:00:00"), ("Quantity", "4"), ("Unit Price", "2.5"), (PRODUCT, "milk")):
        row[RAW_COLUMNS.index(column)] = value
    write_csv(inbox / "q" / "same.csv", [row])
    assert retail.process_folder(spark, str(inbox), output, book, reports=reports) == 0
    assert (flagged("p"), flagged("q")) == (was, 0)
    published = spark.read.parquet(output)
    assert daily_of(published, "/p/same.csv") == plain_job(files["a.csv"])
    assert values(published.where(F.contains(SOURCE_FILE, F.lit("/q/"))), TOTAL) == [(4,)]


def test_folder_job_deletes_on_request(spark, tmp_path, files):
    inbox = inbox_of(tmp_path, {"a.csv": files["a.csv"][:60]})
    status = retail.process_folder(spark, str(inbox), str(tmp_path / "o"), str(tmp_path / "l"), delete_after=True)
    assert status == 0 and not list(inbox.glob("*.csv"))


def test_file_split_into_many_blocks(spark, tmp_path, files):
    """File order must survive when a file is read by several tasks."""
    inbox = inbox_of(tmp_path, {"a.csv": files["a.csv"]})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        assert retail.process_folder(spark, str(inbox), str(tmp_path / "o"), str(tmp_path / "l")) == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert daily_of(spark.read.parquet(str(tmp_path / "o")), "a.csv") == plain_job(files["a.csv"])


def test_stream_of_files(spark, tmp_path, files):
    inbox = inbox_of(tmp_path, files)
    (inbox / "broken.csv").write_text("Date,Quantity\n2024-01-01,1\n")
    output, state, verdicts = (str(tmp_path / n) for n in ("out", "state", "verdicts"))

    def run():
        job = ingest.clean_arriving_files(
            ingest.stream_files(spark, str(inbox), max_files=2), output, state, verdicts, once=True
        )
        job.awaitTermination()
        return spark.read.parquet(output)

    published = run()
    for name, rows in files.items():
        assert daily_of(published, name) == plain_job(rows)
    # Later run: nothing old is processed again, a new file is picked up.
    write_csv(inbox / "late.csv", files["a.csv"][:100])
    published = run()
    assert daily_of(published, "late.csv") == plain_job(files["a.csv"][:100])
    judged = spark.read.parquet(verdicts)
    assert judged.count() == 4
    assert values(judged.where("not valid"), "rows") == [(1,)]
