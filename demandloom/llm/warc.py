"""WARC archives: written by Spark, read back by verified chains of record boundaries.

Writing.  A record is header, blank line, payload and two line ends; ``write_archives`` hands
whole records to Spark's text writer with the two line ends as separator, so archives are
ordinary files of any store Spark reaches.  Of equal payloads (SHA-1) of ``least`` bytes or
more, the record of the smallest ``page_id`` is the response and the others revisit it.

Reading.  The file is split at every place where the magic of a record stands, true starts
and look-alikes inside payloads.  Each place is a candidate; its header's Content-Length
says where its successor starts.  A block of the file is one task's work: it sums the
lengths of its pieces and follows successors inside the block, so a candidate leads to the
first place outside.  Between blocks, pointer jumping from the file's start doubles the
reach in each round and keeps what the chain touches.  A magic inside a payload is not on the
chain and goes back into the payload it belongs to.  How files are cut into blocks changes with
the session's cores, so one read gives all that is keyed by blocks; only the pieces of such
payloads are read again, and they are known by their SHA-256.

Defined results: a null html counts as empty; an empty payload is a payload like any other;
equal payloads without any id are responses; rows alike in id and payload, smallest in their
group, are all responses; a null ``page_id`` comes after all others; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from demandloom.llm.common import prepare
from demandloom.session import scratch_path, stage

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST = 0
#: Fixed value: the capture time in the headers (the pages carry none).
DATE = "2024-01-01T00:00:00Z"
#: Where a candidate stands in one read of the files.
PLACE = ["file", "block", "seq"]


@F.pandas_udf(StringType())
def base32_sha1(payload: pd.Series) -> pd.Series:
    return payload.map(lambda x: None if x is None else base64.b32encode(hashlib.sha1(bytes(x)).digest()).decode())


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, digest, size, first): ``first`` is what a revisit refers to."""
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), payload.cast("binary").alias("raw"))
    keyed = base.select("page_id", "url", "payload", F.octet_length("payload").alias("size"), base32_sha1("raw").alias("digest"))
    # Digests only: a payload in a third of all pages is one row per task here.
    first = stage(
        keyed.select("digest", "page_id").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null").select("digest", "first"),
        "first-pages",
    )
    revisit = (F.col("size") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = keyed.join(first, "digest", "left")
    return joined.withColumn("first", F.when(revisit, F.col("first")))


def record_text(first: Column) -> Column:
    """The record of a row as one string, without its closing line ends."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(key + ": "), value, F.lit("\r\n"))
    again = first.isNotNull()
    body = F.when(again, "").otherwise(F.col("payload"))
    # A line end in a url would end the header field.
    url = F.regexp_replace("url", r"[\r\n]", "%0A")
    return F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Target-URI", url),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, line("WARC-Refers-To", name(first))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """Write one record per page to archives below ``path``, one file per task."""
    found = records(pages, least)
    found.select(record_text(F.col("first")).alias("value")).write.option("lineSep", END).text(path)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, piece): what follows each magic, in file order inside a block."""
    pieces = prepare(spark).read.option("lineSep", MAGIC).text(path)
    return pieces.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Increasing in the order in which a task reads its blocks; like the blocks, it holds for
        # one plan only: another read may cut the files elsewhere.
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").cast("binary").alias("piece"),
    )


def _field(name: str) -> Column:
    return F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _key() -> Column:
    """What a piece is known by in any read, however the files are cut."""
    return F.unhex(F.sha2("piece", 256))


def measured(found: DataFrame, measure) -> DataFrame:
    """(file, block, seq, size, reach, key, record) of each candidate, from one read.

    ``reach`` is how far behind its start a candidate's successor would start.
    """
    text = F.col("piece").cast("string")
    cut = F.instr(text, END)
    size = (F.octet_length("piece") + len(MAGIC)).cast("long")
    head = F.when(cut > 0, F.substring(text, F.lit(1), cut - 1))
    read = found.select(*PLACE, "piece", size.alias("size"), _key().alias("key"), head.alias("head"))
    length = F.when(_field("Content-Length").rlike("^[0-9]{1,15}$"), _field("Content-Length").try_cast("long"))
    header = F.octet_length("head").cast("long") + len(MAGIC) + len(END)
    sized = read.select(*PLACE, "size", (header + length + len(END)).alias("reach"), "key", "piece")
    return _records(sized, [*PLACE, "size", "reach", "key"], measure)


def offsets(sized: DataFrame) -> DataFrame:
    """(file, block, seq, start, next): where each candidate's magic starts and its successor would.

    The first piece of a file is what stands before its first magic.  Offsets are running
    sums: of blocks (one row each) along a file, then of pieces along a block.
    """
    from pyspark.sql import Window

    sized = sized.select(*PLACE, "size", "reach")
    blocks = sized.groupBy("file", "block").agg(F.sum("size").alias("total"))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("file", "block", F.coalesce(F.sum("total").over(along), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    # A piece starts after its magic; the very first one of a file has none before it.
    start = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)) - len(MAGIC)
    placed = sized.join(base, ["file", "block"]).select("file", "block", "seq", start.alias("start"), "reach")
    return placed.select("file", "block", "seq", "start", (F.col("start") + F.col("reach")).alias("next"))


def _leave_block(placed: DataFrame) -> DataFrame:
    """(file, block, start, exit): where the chain from a candidate first leaves its block.

    Pointer jumping inside a block, in one task; a block is a bounded stretch of a file.
    """
    import numpy as np

    def run(key, table):
        start = table.column("start").to_numpy()
        order = np.argsort(start, kind="stable")
        table, start = table.take(pa.array(order)), start[order]
        reach = table.column("next").fill_null(-1).to_numpy()
        slot = np.searchsorted(start, reach)
        inner = (reach >= 0) & (slot < len(start)) & (start[np.minimum(slot, len(start) - 1)] == reach)
        jump = np.where(inner, slot, np.arange(len(start)))
        while True:
            further = jump[jump]
            if (further == jump).all():
                break
            jump = further
        return table.select(["file", "block", "start"]).append_column("exit", pa.array(reach[jump]))

    return placed.select("file", "block", "start", "next").groupBy("file", "block").applyInArrow(
        run, "file string, block long, start long, exit long"
    )


def reachable(placed: DataFrame) -> DataFrame:
    """(file, start) of the true records: the candidates on the chain from the file's start."""
    exits = stage(_leave_block(placed), "warc-exits")
    # Entries of blocks: file starts, and where chains from other blocks lead.
    jump = stage(
        exits.select("file", "start", "exit").join(
            exits.select("file", F.col("exit").alias("start")).union(exits.select("file", F.lit(0).cast("long").alias("start"))).distinct(), ["file", "start"]
        ),
        "warc-entries",
    )
    reached = stage(jump.filter("start = 0").select("file", "start"), "warc-reached")
    count = reached.count()
    # Round k: what is reached in 2^k blocks; pointers then lead twice as far.
    while True:
        ahead = reached.join(jump, ["file", "start"]).select("file", F.col("exit").alias("start"))
        known = jump.select("file", "start")
        grown = stage(reached.union(ahead.join(known, ["file", "start"], "left_semi")).distinct(), "warc-reached")
        size = grown.count()
        if size == count:
            break
        reached, count = grown, size
        second = jump.select("file", F.col("start").alias("exit"), F.col("exit").alias("far"))
        jump = stage(
            jump.join(second, ["file", "exit"], "left").select("file", "start", F.coalesce("far", "exit").alias("exit")), "warc-entries"
        )
    return _inside_blocks(placed, reached)


def _inside_blocks(placed: DataFrame, entries: DataFrame) -> DataFrame:
    """All records on the chains from the entries, block by block."""
    import numpy as np

    def run(key, table):
        start = table.column("start").to_numpy()
        order = np.argsort(start, kind="stable")
        table, start = table.take(pa.array(order)), start[order]
        reach = table.column("next").fill_null(-1).to_numpy()
        on = table.column("entry").to_numpy(zero_copy_only=False).astype(bool)
        slot = np.searchsorted(start, reach)
        inner = (reach >= 0) & (slot < len(start)) & (start[np.minimum(slot, len(start) - 1)] == reach)
        # Successors lie behind, so one pass in file order marks the chain.
        for i in np.flatnonzero(inner):
            if on[i]:
                on[slot[i]] = True
        return table.select(["file", "start"]).filter(pa.array(on))

    marked = placed.join(entries.withColumn("entry", F.lit(True)), ["file", "start"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return marked.select("file", "block", "start", "next", "entry").groupBy("file", "block").applyInArrow(run, "file string, start long")


def read_archives(spark: SparkSession, path: str, measure=lambda payload: {"payload": payload}) -> DataFrame:
    """(record_id, type, url, digest, refers_to, payload) of every true record.

    ``measure`` says what to make of a payload, as named columns; it is applied where a
    piece is read, before any shuffle, unless the payload has to be put together first.
    """
    found = candidates(spark, path)
    sized = stage(measured(found, measure), "warc-candidates")
    placed = stage(offsets(sized), "warc-offsets")
    true = stage(reachable(placed), "warc-records")
    # Each piece belongs to the last true record that starts at or before it.
    own = placed.join(true.withColumn("real", F.lit(True)), ["file", "start"], "left")
    return _payloads(found, sized, own, measure)


def _payloads(found: DataFrame, sized: DataFrame, own: DataFrame, measure) -> DataFrame:
    """Records with their payloads; pieces split off at a magic inside a payload are put back."""
    from pyspark.sql import Window

    # Pieces that are no records are rare; each is looked up by the record before it in its block,
    # or, at a block's head, by the last record of the blocks before it.
    at = Window.partitionBy("file", "block").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    last = own.withColumn("owner", F.last(F.when(F.col("real"), F.col("start")), True).over(at))
    blocks = last.groupBy("file", "block").agg(F.max(F.when(F.col("real"), F.col("start"))).alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.max("last").over(before).alias("carried"))
    owned = last.join(blocks, ["file", "block"]).select("file", "block", "seq", "start", F.coalesce("owner", "carried").alias("owner"), F.col("real").isNotNull().alias("real"))
    owned = stage(owned.filter("owner is not null"), "warc-owners")
    broken = stage(owned.filter("not real").select("file", "owner").distinct(), "warc-broken")
    single = owned.filter("real").join(broken, ["file", "owner"], "left_anti").select(*PLACE)
    whole = sized.join(single, PLACE).select("record.*")
    # A broken record's pieces together are its payload.
    # Written, so that the planner knows how few they are and does not move all pieces.
    parts = stage(
        owned.join(broken, ["file", "owner"], "left_semi").join(sized.select(*PLACE, "key"), PLACE).select("file", "owner", "start", "key"), "warc-parts"
    )
    keys = stage(parts.select("key").distinct(), "warc-keys")
    # Pieces of one key are alike: one of them stands for all.
    again = found.select(_key().alias("key"), "piece").join(keys, "key", "left_semi").dropDuplicates(["key"])
    pieces = parts.join(again, "key")
    joined = (
        pieces.groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("start", F.col("piece").cast("string").alias("piece")))).alias("all"))
        .select(F.array_join(F.transform("all", lambda x: x["piece"]), MAGIC).cast("binary").alias("piece"))
    )
    return whole.unionByName(_records(joined, [], measure).select("record.*"))


def _records(pieces: DataFrame, keep: list[str], measure) -> DataFrame:
    """``record``: what stands in the header of each piece and what ``measure`` makes of its payload."""
    text = pieces.select(*keep, F.col("piece").cast("string").alias("piece"))
    cut = F.instr("piece", END)
    split = text.select(
        *keep, F.substring("piece", F.lit(1), cut - 1).alias("head"), F.substring("piece", cut + len(END), F.length("piece")).alias("rest")
    )
    # Content-Length counts bytes; the payload is followed by the closing line ends.
    payload = F.substring(F.col("rest").cast("binary"), F.lit(1), _field("Content-Length").try_cast("int"))
    fields = split.select(
        *keep, _field("WARC-Record-ID").alias("record_id"), _field("WARC-Type").alias("type"), _field("WARC-Target-URI").alias("url"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"), _field("WARC-Refers-To").alias("refers_to"),
        payload.alias("payload"),
    )
    made = [c.alias(n) for n, c in measure(F.col("payload")).items()]
    return fields.select(*keep, F.struct("record_id", "type", "url", "digest", "refers_to", *made).alias("record"))


def page_number(name: Column) -> Column:
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def archive_report(pages: DataFrame, path: str | None = None, least: int = LEAST) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from archives.

    A response's size and digest are those of the payload that was read; a revisit has
    those of the record it refers to.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, least)
    # A record that is written and not read back is an error, not a shorter result.
    found = stage(
        read_archives(spark, path, lambda payload: {"size": F.octet_length(payload).cast("long"), "read": base32_sha1(payload)}).select(
            page_number(F.col("record_id")).alias("page_id"), "type", page_number(F.col("refers_to")).alias("refers_to"), F.col("digest").alias("written"),
            "size", "read",
        ),
        "warc-read",
    )
    written, back = pages.count(), found.count()
    if written != back:
        raise RuntimeError(f"{written} records were written to {path} and {back} read back")
    responses = found.filter("type = 'response'").select("page_id", "size", F.col("read").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    known = found.filter("type = 'response'").select(F.col("page_id").alias("to"), F.col("read").alias("digest"), F.col("size").alias("bytes")).distinct()
    revisits = found.filter("type = 'revisit'").join(known, (F.col("refers_to") == F.col("to")) & (F.col("written") == F.col("digest"))).select(
        "page_id", F.col("bytes").alias("size"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"
    )
    return responses.union(revisits).select("page_id", F.col("size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
