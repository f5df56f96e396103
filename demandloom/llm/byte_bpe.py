"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is split into pre-tokens by the public pattern.  A pre-token that is in the
vocabulary is one id, found by a minimal perfect hash: every vocabulary entry has a slot
of its own and there are no empty slots.  A miss is merged from its bytes: the pairs of a
doubly linked list of pieces wait in a heap by (rank, position), so the lowest rank and,
on ties, the leftmost pair is merged next, whatever the length of the pre-token.

Defined results: one row per input row, repeated rows and null ids included; a null text
counts as empty and gives no ids and no bytes; bytes that are not UTF-8 count as U+FFFD; a
text of any length is split in slices and never shortened.  Other columns of the input
are not read, so their names can't clash.  An empty table gives an empty result.  In
decoding null ids stay null, and an id outside the vocabulary gives the bytes of U+FFFD.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import prepare, spark_schema

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: A vocabulary travels to every task; a larger file is an error.
MAX_VOCABULARY_BYTES = 32 << 20
#: Merged pre-tokens that one task remembers, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64
#: Pre-tokens held at once for one text.
SLICE = 100_000
POSITION = (1 << 40) - 1

#: Letters and numbers that the ``regex`` module knows and the public
#: encoder, whose tables end with Unicode 16, does not.
LATER_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF "
    "18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 "
    "1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F "
    "2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
LATER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def _ranges(spec: str) -> str:
    return "".join("-".join(f"\\U{int(end, 16):08X}" for end in part.split("-")) for part in spec.split())


class PerfectHash:
    """A minimal perfect hash over byte strings, by hash and displace.

    Keys fall into buckets by one hash.  Buckets with several keys, largest first, get the
    first displacement that puts all of them into free slots; a single key then takes any
    slot that is left, stored as a negative number.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(1, len(ranks))
        self.seed = 0
        while not self._place(list(ranks)):
            self.seed += 1
        self.ids = [ranks.get(key, -1) for key in self.keys]

    def _place(self, keys: list[bytes]) -> bool:
        n, hashed = self.size, {key: xxhash.xxh3_64_intdigest(key, self.seed) for key in keys}
        buckets: dict[int, list[bytes]] = {}
        for key in keys:
            buckets.setdefault(hashed[key] % n, []).append(key)
        self.moves, self.keys = [0] * n, [None] * n
        singles = []
        for at, members in sorted(buckets.items(), key=lambda b: -len(b[1])):
            if len(members) == 1:
                singles.append((at, members[0]))
                continue
            for move in range(n):
                slots = {((h >> 20) + move * (h & 0xFFFFF | 1)) % n for h in (hashed[k] for k in members)}
                if len(slots) == len(members) and all(self.keys[s] is None for s in slots):
                    break
            else:
                return False
            self.moves[at] = move
            for key in members:
                h = hashed[key]
                self.keys[((h >> 20) + move * (h & 0xFFFFF | 1)) % n] = key
        free = iter([s for s in range(n) if self.keys[s] is None])
        for at, key in singles:
            slot = next(free)
            self.moves[at], self.keys[slot] = ~slot, key
        return True

    def find(self, key: bytes) -> int:
        """The id of a key, -1 for any other bytes."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        move = self.moves[h % self.size]
        slot = ~move if move < 0 else ((h >> 20) + move * (h & 0xFFFFF | 1)) % self.size
        return self.ids[slot] if self.keys[slot] == key else -1


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes and ids of a rank file; read on the driver alone."""
    with open(path, "rb") as lines:
        data = lines.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Encoder:
    """Splits, looks up and merges; built on the driver and sent to the tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.table = PerfectHash(ranks)
        self.single = [ranks[bytes([byte])] for byte in range(256)]
        #: The id that two neighbouring ids merge into, for every way to cut a token in two.
        self.pairs = {
            ranks[token[:cut]] << 32 | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.longest = max(map(len, ranks), default=1)
        self.pattern = pattern

    def open(self) -> Encoder:
        """Per task: compiled patterns and the memory of merged pre-tokens."""
        letters, numbers = _ranges(LATER_LETTERS), _ranges(LATER_NUMBERS)
        # For pure ASCII text the classes are short ones and the plain module is faster.
        plain = self.pattern.replace(r"[^\s\p{L}\p{N}]", "[^\t-\r A-Za-z0-9]")
        plain = plain.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.plain = re.compile(plain.replace(r"\S", "[^\t-\r ]").replace(r"\s", "[\t-\r ]"))
        self.full = regex.compile(self.pattern)
        # Both classes cut back, for the rare texts that hold a later code point.
        self.later = regex.compile(f"[{letters}{numbers}]")
        letter, number = f"(?:(?![{letters}])\\p{{L}})", f"(?:(?![{numbers}])\\p{{N}})"
        parts = re.split(r"(\[\^\\s\\p\{L\}\\p\{N\}\]|\\p\{L\}|\\p\{N\})", self.pattern)
        swap = {r"[^\s\p{L}\p{N}]": f"(?:(?!{letter}|{number})\\S)", r"\p{L}": letter, r"\p{N}": number}
        self.exact = regex.compile("".join(swap.get(part, part) for part in parts))
        self.memory = Memory(self)
        return self

    def pieces(self, text: str) -> Iterator[list[str]]:
        pattern = self.plain if text.isascii() else self.exact if self.later.search(text) else self.full
        if len(text) <= 4 * SLICE:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while part := [m.group() for m in islice(found, SLICE)]:
            yield part

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        memory = self.memory
        out = []
        for part in self.pieces(text):
            out.append(b"".join([memory[piece] for piece in part]))
            if len(memory) > REMEMBERED:
                memory.clear()
        return b"".join(out)

    def resolve(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.table.find(data) if len(data) <= self.longest else -1
        ids = [whole] if whole >= 0 else self.merge(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def merge(self, data: bytes) -> list[int]:
        """Ids of bytes that are no vocabulary entry: lowest rank first, leftmost on ties."""
        n, merged = len(data), self.pairs.get
        ids = [self.single[byte] for byte in data]
        after, before = [*range(1, n + 1), n], list(range(-1, n))
        # waiting[i]: the heap entry (rank, i) of the pair that begins at byte i; any other is stale.
        waiting, heap = [-1] * (n + 1), []
        for start in range(n - 1):
            if (rank := merged(ids[start] << 32 | ids[start + 1])) is not None:
                waiting[start] = entry = rank << 40 | start
                heap.append(entry)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            start = entry & POSITION
            if waiting[start] != entry:
                continue
            middle = after[start]
            ids[start] = own = entry >> 40
            waiting[middle] = waiting[start] = -1
            after[start] = end = after[middle]
            if end < n:
                before[end] = start
                if (rank := merged(own << 32 | ids[end])) is not None:
                    waiting[start] = entry = rank << 40 | start
                    heappush(heap, entry)
            left = before[start]
            if left >= 0:
                if (rank := merged(ids[left] << 32 | own)) is not None:
                    waiting[left] = entry = rank << 40 | left
                    heappush(heap, entry)
                else:
                    waiting[left] = -1
        found, start = [], 0
        while start < n:
            found.append(ids[start])
            start = after[start]
        return found


class Memory(dict):
    """Packed ids by pre-token; an unseen one is resolved, and kept unless it is long."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.resolve(piece)
        if len(piece) <= REMEMBERED_CHARS:
            self[piece] = ids
        return ids


def encode(docs: DataFrame, ranks: dict[bytes, int] | None = None, packed: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of every text: array<int>, or if packed little-endian bytes."""
    spark = prepare(docs.sparkSession)
    # Sized by the vocabulary file, whose size is checked.
    encoder = spark.sparkContext.broadcast(Encoder(ranks or read_ranks()))
    kind = pa.binary() if packed else pa.list_(pa.int32())

    def run(batches):
        tokenizer = encoder.value.open()
        for batch in batches:
            found = [tokenizer.encode((t or b"").decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            if packed:
                ids = pa.array(found, type=kind)
            else:
                ends = np.cumsum([0, *(len(f) // 4 for f in found)], dtype="int32")
                ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(found), dtype="<i4"))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    schema = spark_schema(pa.schema([("ids", kind)]))
    schema = type(schema)([docs.schema["doc_id"], *schema.fields])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int] | None = None) -> DataFrame:
    """``doc_id``, ``ids`` as they are, and ``decoded``: the bytes the ids stand for."""
    spark = prepare(encoded.sparkSession)
    tokens = {rank: token for token, rank in (ranks or read_ranks()).items()}
    known = spark.sparkContext.broadcast([tokens.get(i, "�".encode()) for i in range(max(tokens, default=-1) + 1)])

    def run(batches):
        table = known.value
        n, other = len(table), "�".encode()
        for batch in batches:
            out = []
            for ids in batch.column(1).to_pylist():
                if isinstance(ids, bytes):
                    ids = np.frombuffer(ids, dtype="<u4")
                    if not len(ids) or ids.max() < n:
                        out.append(b"".join(map(table.__getitem__, ids.tolist())))
                        continue
                    ids = ids.tolist()
                out.append(None if ids is None else b"".join([table[i] if i is not None and 0 <= i < n else other for i in ids]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, type=pa.binary())], names=["doc_id", "ids", "decoded"])

    schema = spark_schema(pa.schema([("decoded", pa.binary())]))
    schema = type(schema)([encoded.schema["doc_id"], encoded.schema["ids"], *schema.fields])
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)
