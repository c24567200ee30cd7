"""Phrases whose words stand together more often than their parts do apart, from vertically partitioned suffix trees.

The suffixes of all pieces of text, cut after ``DEPTH`` words, are counted group by group:

1. **Vertical partition.** Words are counted; a word that begins at most ``GROUP`` suffixes is a prefix, one that
   begins more is continued by its next word, and so on, so that each prefix fits the memory of a task (prefixes of
   ``DEPTH`` words need no tree: equal suffixes were already added up). Prefixes above a quarter of that are dealt
   into groups by their counts, largest first; the many small ones are dealt by hash to as many groups as their sum needs.
2. **Shuffle.** Each task sends the suffixes of its texts to their groups as compressed blocks, equal ones added up.
3. **Subtrees.** Each group by itself grows its tree a word at a time; a branch with fewer than ``LEAST`` leaves ends
   (nothing below it can be a candidate), the others give a phrase and its count, the total of its leaves.

The counted phrases (at least ``LEAST`` occurrences) are small beside the text; scores, the test for longer phrases
and the ranks are joins, aggregates and a two-step window over them.

Only prefixes above a quarter of the budget are broadcast: at most 4 occurrences / ``GROUP`` of them, and the budget
rises where that would exceed ``TABLE`` entries.

Defined results: null and empty texts hold no words; a null language is ``und`` and counted with it; texts are
taken whole; repeated rows count as often as they stand there; only the named columns are read; without
candidates there are no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.sources.staging import stage

UNKNOWN = "und"
DEPTH = 4
LEAST = 30
GROUP = 4_000_000  # suffixes of a group
TABLE = 1_000_000  # prefixes broadcast at most
TOGETHER = 8_000_000  # bytes of text whose suffixes a task adds up before it sends them
KEPT_WORDS = 500_000  # distinct words a task counts before it sends them
TOP = 2_000
COVERED = 80  # percent of a phrase's occurrences inside one longer phrase that drop it
BUCKETS = 64

# No word holds a full stop, so it can stand for the end of a piece.
END = b"."
_SIGNS = bytes(46 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c for c in range(256))


def tokens_of(texts: list[bytes]) -> list[bytes]:
    """All words of the texts in order, with ``END`` between pieces."""
    return b" . ".join(texts).lower().translate(_SIGNS).replace(END, b" . ").split()


def _slim(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), F.encode(F.col(text_col).cast("string"), "UTF-8").alias("text"))


def _together(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, list[bytes]]]:
    """(language, texts) of about ``limit`` bytes of text at a time."""
    held: defaultdict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                held[lang].append(text)
                size += len(text)
                if size >= limit:
                    yield from held.items()
                    held.clear()
                    size = 0
    yield from held.items()


def word_counts(slim: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: defaultdict[str, Counter] = defaultdict(Counter)
        for lang, texts in chain(_together(batches, TOGETHER // 4), [(None, [])]):
            if lang is not None:
                counts[lang].update(tokens_of(texts))
            if lang is None or sum(map(len, counts.values())) > KEPT_WORDS:
                for name, words in counts.items():
                    words.pop(END, None)
                    yield _phrases([name] * len(words), list(words), list(words.values()))
                counts.clear()

    return slim.mapInArrow(run, "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _phrases(langs: list[str], phrases: list[bytes], counts: list[int]) -> pa.RecordBatch:
    text = pa.array(phrases, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), text, pa.array(counts, pa.int64())], ["lang", "phrase", "f"])


def suffixes(texts: list[bytes], depth: int = DEPTH) -> tuple[list[bytes], np.ndarray]:
    """Words by number (0 is no word), and a row of ``depth`` numbers for each word that another follows."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    number[END]
    tokens = tokens_of(texts)
    ids = np.zeros(len(tokens) + depth, np.int64)
    ids[: len(tokens)] = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    rows = np.empty((len(tokens), depth), np.int64)
    rows[:, 0] = ids[: len(tokens)]
    for k in range(1, depth):
        rows[:, k] = np.where(rows[:, k - 1] > 0, ids[k : k + len(tokens)], 0)
    return list(number), rows[rows[:, min(1, depth - 1)] > 0]


def _by_prefix(words: list[bytes], rows: np.ndarray, depth: int, value: Callable[[bytes], int]) -> np.ndarray:
    """``value`` of each row's first ``depth`` words, found once for each distinct prefix; they must be words."""
    keys = rows[:, 0]
    for k in range(1, depth):
        keys = np.unique(keys, return_inverse=True)[1] * len(words) + rows[:, k]
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    found = (value(b" ".join([words[w] for w in rows[at, :depth]])) for at in first)
    return np.fromiter(found, np.int64, len(first))[which]


class Partition:
    """Which group a prefix belongs to: listed ones by table, the others by hash."""

    SPLIT = -1

    def __init__(self, table: dict[tuple[str, bytes], int], listed: int, hashed: int) -> None:
        self.table, self.listed, self.hashed = table, listed, max(hashed, 1)

    def group(self, lang: str, prefix: bytes) -> int:
        found = self.table.get((lang, prefix))
        if found is None:
            return self.listed + zlib.crc32(prefix, zlib.crc32(lang.encode())) % self.hashed
        return found

    def route(self, lang: str, words: list[bytes], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group and length of the prefix of each row; group ``SPLIT`` where the row ends inside a longer prefix."""
        groups, depth = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64)
        open_ = np.arange(len(rows))
        for d in range(1, rows.shape[1] + 1):
            if not len(open_):
                break
            groups[open_] = _by_prefix(words, rows[open_], d, lambda prefix: self.group(lang, prefix))
            depth[open_] = d
            open_ = open_[groups[open_] == self.SPLIT]
            if d < rows.shape[1]:
                open_ = open_[rows[open_, d] > 0]
        return groups, depth


def _prefix_counts(slim: DataFrame, longer: set[tuple[str, bytes]], depth: int) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``depth`` words whose first ``depth - 1`` are in ``longer``."""
    shared = slim.sparkSession.sparkContext.broadcast(longer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _together(batches, TOGETHER):
            words, rows = suffixes(texts, depth)
            rows = rows[rows[:, depth - 1] > 0]
            for d in range(1, depth):
                if len(rows):
                    begins = {p for name, p in shared.value if name == lang}
                    begins = {b" ".join(p.split(b" ")[:d]) for p in begins}
                    rows = rows[_by_prefix(words, rows, d, begins.__contains__) == 1]
            if len(rows):
                distinct, counts = np.unique(rows, axis=0, return_counts=True)
                phrases = [b" ".join([words[w] for w in row]) for row in distinct]
                yield _phrases([lang] * len(phrases), phrases, counts.tolist())

    return slim.mapInArrow(run, "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def partition(slim: DataFrame, words: DataFrame, group: int = GROUP) -> tuple[Partition, list[tuple[str, str, int]]]:
    """The groups of prefixes, and the counts of the prefixes of two and more words that were continued."""
    total = words.agg(F.sum("f")).first()[0] or 0
    group = max(group, 4 * total // TABLE)
    listed: list[tuple[int, str, bytes]] = []
    table: dict[tuple[str, bytes], int] = {}
    counted: list[tuple[str, str, int]] = []
    rest, counts = total, words
    for depth in range(1, DEPTH + 1):
        large = counts.where(F.col("f") > group // 4).collect()  # at most 4 total / group rows
        longer = {(r.lang, r.phrase.encode()) for r in large if r.f > group} if depth < DEPTH else set()
        for r in large:
            key = (r.lang, r.phrase.encode())
            if key in longer:
                table[key] = Partition.SPLIT
                if depth > 1:
                    counted.append((r.lang, r.phrase, r.f))
            else:
                listed.append((r.f, *key))
                rest -= min(r.f, rest)
        if not longer:
            break
        counts = stage(_prefix_counts(slim, longer, depth + 1), f"prefixes-{depth + 1}")
    groups, room = 0, 0
    for f, lang, prefix in sorted(listed, reverse=True):
        if f > room:
            groups, room = groups + 1, group
        table[(lang, prefix)] = groups - 1
        room -= min(f, room)
    return Partition(table, groups, -(-rest // max(group * 4 // 5, 1))), counted


def _pack(words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> bytes:
    """A block: the words that stand in it, the rows column by column, the counts."""
    if len(rows) * 16 > len(words):
        used = np.zeros(len(words), bool)
        used[rows] = True
        used[0] = False
        number = np.cumsum(used)
        used = np.flatnonzero(used)
    else:
        used = np.unique(rows)
        used = used[used > 0]
        number = None
    local = np.where(rows > 0, np.searchsorted(used, rows) + 1, 0) if number is None else np.where(rows > 0, number[rows], 0)
    kind = "<u2" if len(used) < 65536 else "<u4"
    text = b" ".join([words[w] for w in used])
    cells = local.T.astype(kind).tobytes() + counts.astype("<u8").tobytes()
    return struct.pack("<II", len(text), len(rows)) + zstandard.compress(text + cells, 3)


def _unpack(block: bytes, depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    size, n = struct.unpack_from("<II", block)
    data = zstandard.decompress(block[8:])
    words = data[:size].split(b" ")
    kind = "<u2" if len(words) < 65536 else "<u4"
    rows = np.frombuffer(data, kind, n * depth, size).reshape(depth, n).T
    return words, rows, np.frombuffer(data, "<u8", n, len(data) - 8 * n).astype(np.int64)


def _blocks(slim: DataFrame, parts: Partition) -> DataFrame:
    """(group, lang, depth, block): the suffixes of each task's texts, by group; ``depth`` words are their prefix."""
    shared = slim.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _together(batches, TOGETHER):
            words, rows = suffixes(texts)
            groups, depth = shared.value.route(lang, words, rows)
            kept = groups != Partition.SPLIT
            rows, key = rows[kept], (groups * DEPTH + depth - 1)[kept]
            if not len(rows):
                continue
            one = rows[:, 0] * len(words) + rows[:, 1]
            two = rows[:, 2] * len(words) + rows[:, 3]
            order = np.lexsort((two, one, key))
            new = np.ones(len(order), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(order)))
            rows, key = rows[order[first]], key[order[first]]
            cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            keys = key[cuts[:-1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys // DEPTH, pa.int32()),
                    pa.array([lang] * len(keys), pa.string()),
                    pa.array(keys % DEPTH + 1, pa.int32()),
                    pa.array([_pack(words, rows[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                ],
                ["group", "lang", "depth", "block"],
            )

    return slim.mapInArrow(run, "group int, lang string, depth int, block binary")


def _subtree(blocks: list[tuple[int, bytes]], least: int) -> tuple[list[bytes], list[int]]:
    """Phrases of two and more words with their totals of leaves, from one language's blocks of a group."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = lambda: len(number) + 1
    parts, counts, depths = [], [], []
    for depth, block in blocks:
        words, rows, n = _unpack(block, DEPTH)
        names = np.zeros(len(words) + 1, np.int32)
        names[1:] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        parts.append(names[rows])
        counts.append(n)
        depths.append(np.full(len(n), depth, np.int8))
    words = [b"", *number]
    rows, leaves, depth = np.concatenate(parts), np.concatenate(counts), np.concatenate(depths)
    parts = counts = depths = None
    phrases: list[bytes] = []
    totals: list[int] = []
    node = np.zeros(len(rows), np.int64)
    for k in range(DEPTH):
        on = rows[:, k] > 0
        rows, leaves, depth, node = rows[on], leaves[on], depth[on], node[on]
        _, first, node = np.unique(node * len(words) + rows[:, k], return_index=True, return_inverse=True)
        # Leaves are whole numbers below 2^53, so their sums as doubles are exact.
        total = np.bincount(node, leaves, len(first)).astype(np.int64)
        whole = depth[first] <= k + 1  # else part of the prefix lies in other groups
        if k:
            for at in np.flatnonzero(whole & (total >= least)):
                phrases.append(b" ".join([words[w] for w in rows[first[at], : k + 1]]))
                totals.append(int(total[at]))
        going_on = ((total >= least) | ~whole)[node]
        rows, leaves, depth, node = rows[going_on], leaves[going_on], depth[going_on], node[going_on]
    return phrases, totals


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to ``DEPTH`` words with ``least`` occurrences, and (lang, n) of all words."""
    slim = _slim(docs, text_col, lang_col)
    words = stage(word_counts(slim), "words")
    parts, counted = partition(slim, words, group)

    def grow(table: pa.Table) -> pa.Table:
        out = []
        for lang in sorted(set(table.column("lang").to_pylist())):
            rows = zip(*(table.column(c).to_pylist() for c in ("lang", "depth", "block")))
            phrases, totals = _subtree([(depth, block) for name, depth, block in rows if name == lang], least)
            out.append(_phrases([lang] * len(phrases), phrases, totals))
        return pa.Table.from_batches(out)

    schema = "lang string, phrase string, f bigint"
    trees = _blocks(slim, parts).groupBy("group").applyInArrow(grow, schema)
    hot = docs.sparkSession.createDataFrame(counted, schema)
    single = words.where(F.col("f") >= least)
    phrases = stage(single.unionByName(trees).unionByName(hot.where(F.col("f") >= least)), "phrases")
    return phrases, words.groupBy("lang").agg(F.sum("f").alias("n"))


def _cut(words: Column, first: int, size: int) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the phrases of two and more words, by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    many = phrases.where(F.contains("phrase", F.lit(" "))).withColumn("words", words).withColumn("size", F.size("words"))
    at = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = many.select("lang", "phrase", "size", F.col("f").alias("a"), "words", at.alias("k")).select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.expr("slice(words, 1, k)"), " ").alias("_first"),
        F.array_join(F.expr("slice(words, k + 1, size - k)"), " ").alias("_rest"),
    )
    known = phrases.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    cuts = cuts.join(known, ["lang", "_first"]).join(
        phrases.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r")), ["lang", "_rest"]
    )
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "size", "a").agg(best.alias("x")).select(
        "lang", "phrase", "size", "a", "x.l", "x.r", "x.score"
    )


def without_parts(candidates: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates that do not mostly stand inside one longer candidate."""
    words = F.split("phrase", " ")
    inner = [
        F.when(F.col("size") == whole, F.array(*[_cut(words, at, size) for size in range(2, whole) for at in range(1, whole - size + 2)]))
        for whole in range(3, DEPTH + 1)
    ]
    longer = candidates.where(F.col("size") > 2).select("lang", F.col("a").alias("_f"), F.explode(F.coalesce(*inner)).alias("phrase"))
    largest = longer.groupBy("lang", "phrase").agg(F.max("_f").alias("_f"))
    joined = candidates.join(largest, ["lang", "phrase"], "left")
    much = F.expr(f"cast(_f as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {int(covered)}")
    return joined.where(~F.coalesce(much, F.lit(False))).drop("_f")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, least: int = LEAST, group: int = GROUP) -> DataFrame:
    """Each language's first ``top`` phrases by score, occurrences and text."""
    phrases, sizes = phrase_counts(docs, text_col, lang_col, least, group)
    kept = without_parts(stage(scored(phrases), "scored"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # The first of each bucket before the first of all, so that no task sees more than BUCKETS * top of a language.
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    some = kept.withColumn("_b", bucket)
    some = some.withColumn("_p", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order))).where(F.col("_p") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
