"""Byte-level BPE by folding ranked merges in Spark's higher-order functions.

Within a task, Python only looks up: it cuts each text into blank-led segments, numbers the distinct
segments and their words, and lists for each new word the tokens that stand in it. The JVM does the
rest for each distinct word: a fold over those tokens by rank replaces the pair of pieces that a token
merges, read from a literal map by rank, and decoding concatenates the binary pieces of the ids.
Python then lays out every document's ids and decoded bytes from the numbers and hashes them.

A piece is one character in the fold, its id plus ``BASE``, so a merge is one string replacement.
Every token of a trained vocabulary is reached by merges of lower rank, which makes merging in the
order of ranks equal to merging the lowest pair at each step; ``merge_pairs`` fails for a vocabulary
where that does not hold.

No shuffle is needed, a task holds the words it has met (starting anew above ``MEMORY``) and a batch
of documents, and a lost task is repeated alone. Words above ``LONG_WORD`` bytes would make their list
of tokens long; a heap merges those, with equal results.

Defined results: a null text is an empty text and has no ids; texts are encoded whole; repeated rows
give one row each; an empty table gives no rows; only the two named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_WORD = 256
MEMORY = 400_000
# Ids become characters from here on; the largest stays below the surrogates.
BASE = 0x100

# Unicode white space, as the splitting pattern's \s means it.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SEGMENT = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[int, int] | None]:
    """For each rank the ids of the two pieces that its token merges; none for single bytes."""
    if max(ranks.values()) + BASE >= 0xD800:
        raise ValueError("too many tokens for one character each")
    out: list[tuple[int, int] | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        if len(token) > 1:
            pieces = merge_long(token, ranks, rank)
            if len(pieces) != 2:
                raise ValueError(f"token {rank} is not reached by merges of lower rank")
            out[rank] = (pieces[0], pieces[1])
    return out


def _literal(values: list[str]) -> Column:
    """An array literal; the text has no commas of its own."""
    return F.split(F.lit(",".join(values)), ",")


def fold_word(word: Column, pairs: Column) -> Column:
    """Pieces of a word (``s``, a character each) after the merges of ``tokens``, ranks in rising order."""


    def merge(s: Column, rank: Column) -> Column:
        entry = F.get(pairs, rank)  # the two pieces, then the token
        return F.replace(s, F.substring(entry, 1, 2), F.substring(entry, 3, 1))

    return F.aggregate(word["tokens"], word["s"], merge)


def decode_word(s: Column, pieces: Column) -> Column:
    """The binary pieces of a folded word, concatenated."""
    digits = F.transform(F.split(s, ""), lambda c: F.get(pieces, F.ascii(c) - BASE))
    return F.unhex(F.array_join(digits, ""))


def merge_long(word: bytes, ranks: dict[bytes, int], below: int = 1 << 31) -> list[int]:
    """Ids of a word of any length, from merges of a rank below ``below``.

    Pairs wait in a heap, pieces in a linked list.
    """
    ends = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    size = len(word)

    def pair(i: int) -> None:
        if ends[i] < size and (rank := ranks.get(word[i : ends[ends[i]]], below)) < below:
            heapq.heappush(heap, (rank, i, ends[ends[i]]))

    heap: list[tuple[int, int, int]] = []
    for i in range(size):
        pair(i)
    while heap:
        _, i, end = heapq.heappop(heap)
        if ends[i] < 0 or ends[i] == size or ends[i] >= end or ends[ends[i]] != end:
            continue  # one of its pieces has been merged since
        ends[ends[i]], ends[i] = -1, end
        if end < size:
            before[end] = i
        pair(i)
        if before[i] >= 0:
            pair(before[i])
    out, i = [], 0
    while i < size:
        out.append(ranks[word[i : ends[i]]])
        i = ends[i]
    return out


class Tokens:
    """Looks up which tokens stand in a word: hashes of all tokens and of all that begins one, sorted."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ranks: dict[bytes, int]) -> None:
        numbers = {t[:i]: -1 for t in ranks for i in range(1, len(t))}
        numbers.update(ranks)
        keys = np.array([self._hash(t) for t in numbers], np.uint64)
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], np.array(list(numbers.values()), np.int64)[order]
        self.longest = max(map(len, ranks))
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two tokens share a hash")

    def _hash(self, token: bytes) -> int:
        out = 0
        for c in token:
            out = (out * int(self.FACTOR) + c + 1) % 2**64
        return out

    def inside(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word number, rank) of all tokens of two bytes and more, by word, then rank, each once."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
        row = np.repeat(np.arange(len(words)), sizes)
        at = np.arange(len(row))
        end = np.repeat(np.cumsum(sizes), sizes)
        hashes = np.zeros(len(row), np.uint64)
        found = []
        for length in range(1, self.longest + 1):
            fits = at + length <= end
            row, at, end, hashes = row[fits], at[fits], end[fits], hashes[fits]
            if not len(row):
                break
            hashes = hashes * self.FACTOR + data[at + length - 1] + np.uint64(1)
            place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            known = self.keys[place] == hashes
            number = np.where(known, self.numbers[place], -1)
            if length > 1:
                hit = number >= 0
                found.append(row[hit] << 32 | number[hit])
            row, at, end, hashes = row[known], at[known], end[known], hashes[known]
        codes = np.sort(np.concatenate([*found, np.zeros(0, np.int64)]))
        codes = codes[np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)]]
        return codes >> 32, codes & 0xFFFFFFFF


class Numbers(dict):
    """Numbers its keys from 0 as they come."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


CHUNK = (
    "ids array<{kind}>, counts array<int>, codes array<int>, fresh boolean, "
    "words array<struct<s:string,tokens:array<int>>>, segments array<array<int>>"
)


def _one(values: pa.Array) -> pa.ListArray:
    """A column of one row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _split(pattern: str, ranks: dict[bytes, int]):
    """Per Arrow batch one row: the batch's documents as segment numbers, and the words and segments new to the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, tokens = regex.compile(pattern), Tokens(ranks)
        letters = [chr(ranks[bytes([i])] + BASE) for i in range(256)]
        segment_numbers, word_numbers = Numbers(), Numbers()
        for batch in batches:
            fresh = len(word_numbers) > MEMORY or not word_numbers
            if fresh:
                segment_numbers, word_numbers = Numbers(), Numbers()
            n_segments, n_words = len(segment_numbers), len(word_numbers)
            counts, codes = [], []
            for text in batch.column(1).to_pylist():
                found = SEGMENT.findall(text or "")
                counts.append(len(found))
                codes += map(segment_numbers.__getitem__, found)
            parts = []
            for s in islice(segment_numbers, n_segments, None):
                # A run of letters, after one space at most, is one word to the pattern.
                found = [s] if s.removeprefix(" ").isalpha() else splitter.findall(s)
                parts.append([word_numbers[w] for w in found])
            words = [w.encode("utf-8", "replace") for w in islice(word_numbers, n_words, None)]
            short = [w if len(w) <= LONG_WORD else b"" for w in words]
            row, rank = tokens.inside(short)
            start = [
                "".join([letters[c] for c in w]) if t else "".join(chr(i + BASE) for i in merge_long(w, ranks))
                for w, t in zip(words, short)
            ]
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(len(words) + 1)), pa.int32()), pa.array(rank, pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    _one(batch.column(0)),
                    _one(pa.array(counts, pa.int32())),
                    _one(pa.array(codes, pa.int32())),
                    pa.array([fresh]),
                    _one(pa.StructArray.from_arrays([pa.array(start, pa.string()), lists], ["s", "tokens"])),
                    _one(pa.array(parts, pa.list_(pa.int32()))),
                ],
                ["ids", "counts", "codes", "fresh", "words", "segments"],
            )

    return run


def _ragged(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists numbered ``codes`` one after the other, and where each of them ends."""
    sizes = np.diff(offsets)[codes]
    ends = np.cumsum(sizes)
    at = np.repeat(offsets[:-1][codes] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return values[at], ends


class Table:
    """Lists of numbers under consecutive numbers, to which more are added."""

    def __init__(self, kind: str) -> None:
        self.values, self.offsets = np.zeros(0, kind), np.zeros(1, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values.astype(self.values.dtype)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])


def _lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order in which the task has split them; its words and segments add up."""
    tokens, decoded, segments = Table("<u4"), Table("u1"), Table("i8")
    for batch in batches:
        for row in range(batch.num_rows):
            column = lambda name: batch.column(name)[row].values  # noqa: B023, E731
            if batch.column("fresh")[row].as_py():
                tokens, decoded, segments = Table("<u4"), Table("u1"), Table("i8")
            folded = column("tokens").to_pylist()
            ids = np.frombuffer("".join(folded).encode("utf-16-le"), "<u2").astype("<u4") - np.uint32(BASE)
            tokens.add(ids, np.array([len(x) for x in folded], np.int64))
            pieces = column("decoded").to_pylist()
            decoded.add(np.frombuffer(b"".join(pieces), np.uint8), np.array([len(x) for x in pieces], np.int64))
            parts = column("segments")
            segments.add(
                parts.flatten().to_numpy(zero_copy_only=False), parts.value_lengths().to_numpy(zero_copy_only=False)
            )
            codes, counts = (column(x).to_numpy(zero_copy_only=False) for x in ("codes", "counts"))
            words, word_ends = _ragged(segments.values, segments.offsets, codes)
            flat, token_ends = _ragged(tokens.values, tokens.offsets, words)
            raw, byte_ends = _ragged(decoded.values, decoded.offsets, words)
            last = np.concatenate([[0], np.cumsum(counts)])
            last = np.concatenate([[0], word_ends])[last]  # words before each document's end
            t, b = (np.concatenate([[0], ends])[last] for ends in (token_ends, byte_ends))
            n = range(len(counts))
            yield pa.RecordBatch.from_arrays(
                [
                    column("ids"),
                    pa.array(np.diff(t), pa.int64()),
                    pa.array([hashlib.sha256(flat[t[i] : t[i + 1]].tobytes()).hexdigest() for i in n], pa.string()),
                    pa.array([hashlib.sha256(raw[b[i] : b[i + 1]].tobytes()).hexdigest() for i in n], pa.string()),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def folded_batches(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Batches of documents with the pieces (``tokens``) and the decoded bytes of each new word."""
    ranks = read_ranks(path)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    split = slim.mapInArrow(_split(pattern, ranks), CHUNK.format(kind=kind))
    shown = ["".join(chr(i + BASE) for i in (*pair, rank)) if pair else "" for rank, pair in enumerate(merge_pairs(ranks))]
    by_id = [""] * len(shown)
    for token, rank in ranks.items():
        by_id[rank] = token.hex()
    pairs, pieces = _literal(shown), _literal(by_id)
    folded = split.select(
        "ids", "counts", "codes", "fresh", "segments", F.transform("words", lambda w: fold_word(w, pairs)).alias("tokens")
    )
    return folded.select("*", F.transform("tokens", lambda s: decode_word(s, pieces)).alias("decoded"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: token count and the digests of its ids and of their decoded bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        folded_batches(docs, path, pattern)
        .mapInArrow(_lay_out, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
        .withColumnRenamed("id", "doc_id")
    )
