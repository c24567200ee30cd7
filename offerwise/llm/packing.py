"""Packing of documents into sequences by Karmarkar-Karp multiway differencing.

A document's token ids end with one separator id. Full windows are cut off its front; what is left is
cut into pieces of at most ``PIECE`` tokens, and the pieces of a block are dealt to as few windows as
hold them: two partial partitions with the largest spread are merged again and again, the largest
windows of one with the smallest of the other, until one partition with near-equal windows is left.
If its largest window exceeds the capacity, the number of windows rises and the block is dealt anew.

Every task packs what it reads, block by block, so nothing is shuffled and a lost task is repeated
alone. Sequence ids are the partition's number times 2^33 plus a running number.

Defined results: a null or empty text is the separator alone; texts are read whole; repeated rows are
packed each for itself; an empty table gives no pieces; only the two named columns are read.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
PIECE = 512
BLOCK = 1024  # pieces dealt together
SEPARATOR = 1
# Distinct words a worker remembers; beyond that it starts anew.
MEMORY = 500_000
# A run of Latin letters whose composed and lower-cased forms are single letters, then ASCII signs
# (no apostrophe: the splitter keeps some endings with it).
SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")
# The byte-level alphabet: printable Latin-1 characters stand for themselves, all other bytes for
# the characters from 256 on, in order.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

SCHEMA = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class WordEncoder:
    """Token ids of whole texts, as packed little-endian 32-bit ids.

    The vocabulary's normaliser and splitter never join across white space, so a text's ids are
    those of its blank-separated parts in turn, and each part is encoded once. A part that is one run
    of Latin letters and one of signs is two words to the splitter, so its letters go to the merges
    directly, once for all capitalisations; every other part goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > MEMORY:
            self.known, self.runs = {}, {}
        out = []
        for text in texts:
            parts = text.encode("utf-8", "replace").split()
            ids = list(map(self.known.get, parts))
            if None in ids:
                ids = [self._learn(part) if i is None else i for part, i in zip(parts, ids)]
            out.append(b"".join(ids))
        return out

    def _learn(self, part: bytes) -> bytes:
        word = part.decode()
        if simple := SIMPLE.fullmatch(word):
            letters = simple[1].lower()
            ids = self.runs.get(letters) or self._run(letters)
            if simple[2]:
                ids += self.runs.get(simple[2]) or self._run(simple[2])
        else:
            ids = packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self.known[part] = ids
        return ids

    def _run(self, run: str) -> bytes:
        shown = run if run.isascii() else run.encode().decode("latin-1").translate(BYTE_CHARS)
        ids = packed([t.id for t in self.model.tokenize(shown)])
        self.runs[run] = ids
        return ids


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _merge(a: list, b: list, windows: int) -> list:
    """Partition of the union: a's largest windows with b's smallest. Zero windows are left out."""
    over = len(a) + len(b) - windows
    if over <= 0:
        out = a + b
    else:
        first, last = len(a) - over, len(b) - 1
        joined = [(a[first + i][0] + b[last - i][0], (a[first + i][1], b[last - i][1])) for i in range(over)]
        out = a[:first] + b[: len(b) - over] + joined
    out.sort(key=lambda w: -w[0])
    return out


def difference(sizes: list[int], windows: int) -> list[tuple[int, object]]:
    """Karmarkar-Karp: windows as (sum, nested pairs of item numbers), largest first."""
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    if windows == 1:
        heap = [(0, i, part) for _, i, part in heap]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        part = _merge(a, b, windows)
        spread = part[0][0] - (part[-1][0] if len(part) == windows else 0)
        heapq.heappush(heap, (-spread, i, part))
    return heap[0][2] if heap else []


def _items(nest: object) -> list[int]:
    out, todo = [], [nest]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo += [x[1], x[0]]
        else:
            out.append(x)
    return out


def deal(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers of each window; no window holds more than ``capacity``."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        part = difference(sizes, windows)
        if not part or part[0][0] <= capacity:
            return [_items(nest) for _, nest in part]
        windows += max(1, windows // 200)


def cut(tokens: int, capacity: int = CAPACITY, piece: int = PIECE) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(start, length) of full windows and of the pieces of what is left, as even as possible."""
    full = tokens // capacity
    rest = tokens - full * capacity
    n = -(-rest // piece)
    edges = [full * capacity + rest * i // n for i in range(n + 1)] if n else []
    return [(i * capacity, capacity) for i in range(full)], [(a, b - a) for a, b in zip(edges, edges[1:])]


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", *(x.split()[0] for x in SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []

        def placed(whole: list[tuple], rest: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal sequence
            out = []
            for row in whole:
                out.append((*row, sequence, 0))
                sequence += 1
            for window in deal([row[2] for row in rest]) if rest else []:
                offset = 0
                for i in window:
                    out.append((*rest[i], sequence, offset))
                    offset += rest[i][2]
                sequence += 1
            types = [id_type] + [pa.int64()] * 6
            columns = [pa.array([row[i] for row in out], t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, names)

        id_type = None
        tail = SEPARATOR.to_bytes(4, "little")
        for batch in batches:
            id_type = batch.column(0).type
            texts = [t or "" for t in batch.column(1).to_pylist()]
            whole: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(vocabulary).encode(texts)):
                ids += tail
                total = len(ids) // 4
                row = lambda s, n: (doc, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), total)  # noqa: B023, E731
                full, rest = cut(total)
                whole += [row(*x) for x in full]
                waiting += [row(*x) for x in rest]
            if whole:
                yield placed(whole, [], id_type)
            while len(waiting) >= BLOCK:
                yield placed([], waiting[:BLOCK], id_type)
                waiting = waiting[BLOCK:]
        if waiting:
            yield placed([], waiting, id_type)

    return slim.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)
