"""Live demand: the same result for any cut into batches, late rows aside, retries without effect."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

from demandloom.schema import BRONZE, DATE, PRODUCT, TOTAL
from demandloom.streaming import live

START = datetime(2024, 3, 1)


def made(seed, n, ids, disorder_hours=20):
    """Rows roughly in order of time, IDs repeated soon and late, one ID very often."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        at = START + timedelta(hours=3 * i / 2 - rng.uniform(0, disorder_hours))
        at = at.replace(microsecond=0, second=0)
        tx = "HOT" if i % 3 == 0 else f"T{rng.randrange(ids)}"
        rows.append((at.strftime("%Y-%m-%d %H:%M:%S"), "1", str(rng.randrange(1, 9)), tx, "s", rng.choice([" Milk ", "beef"]), "1"))
    return rows


def plain(rows, lateness):
    """A row counts unless the row of its ID before it is at most ``lateness`` older."""
    by_id = defaultdict(list)
    for k, r in enumerate(rows):
        by_id[r[3]].append((datetime.strptime(r[0], "%Y-%m-%d %H:%M:%S"), k, r))
    total = defaultdict(int)
    for found in by_id.values():
        before = None
        for at, _, r in sorted(found):
            if before is None or at - before > lateness:
                total[at.date(), r[5].strip().lower()] += int(r[2])
            before = at
    return dict(total)


def write(spark, folder, rows, cuts):
    """Files in order of name, a row a line, cut at the given places."""
    folder.mkdir()
    edges = [0, *sorted(cuts), len(rows)]
    for k, (s, e) in enumerate(zip(edges, edges[1:])):
        if e > s:
            path = str(folder / f"p{k:03d}")
            spark.createDataFrame(rows[s:e], BRONZE).coalesce(1).write.json(path)


def run(spark, tmp_path, name, max_files, lateness):
    job = live.LiveDemand(spark, str(tmp_path / f"{name}-{max_files}"), lateness)
    rows = live.stream_transactions(spark, str(tmp_path / name), max_files=max_files)
    job.start(rows, str(tmp_path / f"{name}-{max_files}-checkpoint"), once=True).awaitTermination()
    return job


def found(df):
    return {(r[DATE], r[PRODUCT]): r[TOTAL] for r in df.collect()}


def test_any_cut_gives_the_same_result(spark, tmp_path):
    lateness = timedelta(days=2)
    rows = made(7, 120, 15)
    expected = plain(rows, lateness)
    write(spark, tmp_path / "a", rows, [10, 55, 90])
    for max_files in (1, 100):
        job = run(spark, tmp_path, "a", max_files, lateness)
        assert found(job.current_daily()) == expected
        assert job.late_rows().isEmpty()
        # What is called final stays; here that is the greater part.
        final = found(job.final_daily())
        assert final and sum(final.values()) < sum(expected.values())


def row(stamp, quantity, tx, product="milk"):
    return (stamp, "1", str(quantity), tx, "s", product, "1")


def test_late_rows_ties_and_missing_values(spark, tmp_path):
    first = [
        row("2024-03-04 11:00:00", 7, "T1"), row("2024-03-04 10:00:00", 5, "T1"), row("2024-03-04 12:00:00", 2, "T2"),
        row("2024-03-04 12:00:00", 9, "T2"), row("2024-03-05 12:00:00", 1, "T3", "tea"), row(None, 4, "T5"),
        row("2024-03-04 13:00:00", 3, None), row("2024-03-04 13:00:00", 3, None), row("2024-03-20 12:00:00", 1, "T4"),
    ]
    late = [row("2024-03-04 09:00:00", 50, "T1"), row("2024-03-20 13:00:00", 8, "T4"), row("2024-03-30 12:00:00", 6, "T1")]
    write(spark, tmp_path / "b", first + late, [len(first)])
    job = run(spark, tmp_path, "b", 1, timedelta(days=2))
    assert found(job.current_daily()) == {
        (date(2024, 3, 4), "milk"): 5 + 2 + 3 + 3, (date(2024, 3, 20), "milk"): 1, (date(2024, 3, 30), "milk"): 6,
    }
    assert [(r.id, r.Quantity) for r in job.late_rows().collect()] == [("T1", 50)]


def test_a_retried_batch_changes_nothing(spark, tmp_path):
    lateness = timedelta(days=1)
    rows = made(9, 60, 8, disorder_hours=5)
    write(spark, tmp_path / "c", rows, [25])
    once = run(spark, tmp_path, "c", 1, lateness)
    before = found(once.current_daily())
    assert before == plain(rows, lateness)
    # The same batch again, as after a failure: its tables are replaced.
    batch = (
        spark.read.schema(BRONZE).json(str(tmp_path / "c" / "p001"))
        .selectExpr("*", "_metadata.file_path AS source_file", "_metadata.file_block_start AS row_block")
    )
    once.process(batch, once.last_batch())
    assert found(once.current_daily()) == before
    # An empty batch carries state and watermark on.
    once.process(batch.limit(0), once.last_batch() + 1)
    assert found(once.current_daily()) == before


def test_waiting_files_are_done_in_few_batches(spark, tmp_path):
    rows, lateness = made(11, 80, 9), timedelta(days=60)
    write(spark, tmp_path / "many", rows, range(2, 80, 2))
    files = sum(1 for _ in (tmp_path / "many").rglob("*.json"))
    job = run(spark, tmp_path, "many", live.files_per_batch(files), lateness)
    assert 1 < job.last_batch() + 1 <= live.CATCH_UP_BATCHES < files
    assert found(job.current_daily()) == plain(rows, lateness)
    assert [live.files_per_batch(n) for n in (0, 1, 16, 17, 40)] == [1, 1, 1, 2, 3]
