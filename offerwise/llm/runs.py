"""Periodic runs of words, by recompression.

A batch of texts becomes one string of word numbers, a separator of its own before and after each text.
Recompression alternates two steps until a text is a letter or two: each maximal block of equal letters
becomes one letter, then each pair of a "left" and a "right" letter does. The levels are the parse tree of a
run-length grammar of the string, in which equal stretches have equal letters but for their ends; so how
far two positions agree (to the right, or mirrored to the left) is found by climbing while letters agree
and descending where they differ, for many pairs of positions at once.

A run with period q and length 4q or more holds three neighbouring multiples of q whose words equal those
q further. These points of the harmonic grid (all multiples of all q up to a quarter of the text: n log n of
them) are the candidates; grammar queries to both sides give each one's exact run.

Nothing is shuffled and no text is cut: a task works through its own rows, at most ``TOGETHER`` words (or one
text) at a time, and at most ``QUERIES`` candidates at a time.

Defined results: a null or empty text has no words and no runs; texts are taken whole; repeated rows give one
row each; a null id stays null (and its text as it is in :func:`with_cyclic_tails`); only the named columns
are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST = 6  # words of a run, and
POWERS = 4  # how often its period must fit into it
TOGETHER = 1_000_000
QUERIES = 1_000_000
SEEDS = 4  # divisions into left and right letters tried at each level; the one with most pairs is taken


@dataclass
class Level:
    """One string of the grammar: its letters, each one's parent in the next string, each parent's first letter."""

    letters: np.ndarray
    parent: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = True  # whether the next string's letters are blocks (else pairs)

    def left(self, at: np.ndarray) -> np.ndarray:
        """Letters from ``at`` to the end of its parent."""
        after = self.parent[at] + 1
        ends = np.append(self.first, len(self.letters))
        return ends[after] - at

    def mirrored(self) -> "Level":
        size = len(self.letters)
        if self.parent is None:
            return Level(self.letters[::-1])
        last = np.append(self.first[1:], size) - 1
        return Level(self.letters[::-1], len(self.first) - 1 - self.parent[::-1], size - 1 - last[::-1], self.blocks)


def _named(keys: np.ndarray, first_name: int) -> tuple[np.ndarray, int]:
    """Equal keys get equal new letters."""
    distinct, names = np.unique(keys, return_inverse=True)
    return names + first_name, first_name + len(distinct)


def _starts_to_parents(starts: np.ndarray) -> np.ndarray:
    return np.cumsum(starts) - 1


def _blocks(letters: np.ndarray, known: int) -> tuple[Level, np.ndarray, int]:
    starts = np.ones(len(letters), bool)
    starts[1:] = letters[1:] != letters[:-1]
    first = np.flatnonzero(starts)
    sizes = np.diff(np.append(first, len(letters)))
    out = letters[first]
    long = sizes > 1
    if long.any():
        out[long], known = _named(out[long] * (int(sizes.max()) + 1) + sizes[long], known)
    return Level(letters, _starts_to_parents(starts), first, True), out, known


def _pairs(letters: np.ndarray, known: int, round_: int) -> tuple[Level, np.ndarray, int]:
    best = None
    for seed in range(SEEDS):
        odd = np.uint64((0x9E3779B97F4A7C15 + 2 * (round_ * SEEDS + seed) * 0x632BE59BD9B4E019) % 2**64 | 1)
        is_left = ((letters.astype(np.uint64) + np.uint64(seed + 1)) * odd) >> np.uint64(63) == 0
        for side in (is_left, ~is_left):
            pair = side[:-1] & ~side[1:]
            if best is None or np.count_nonzero(pair) > np.count_nonzero(best):
                best = pair
    starts = np.ones(len(letters), bool)
    starts[1:] = ~best
    first = np.flatnonzero(starts)
    out = letters[first]
    at = np.flatnonzero(best)
    if len(at):
        names, known_after = _named(letters[at] * known + letters[at + 1], known)
        out[np.append(best, False)[first]] = names
        known = known_after
    return Level(letters, _starts_to_parents(starts), first, False), out, known


def grammar(letters: np.ndarray, enough: int) -> list[Level]:
    """The strings from the words up, until one has at most ``enough`` letters."""
    levels, known, round_ = [], int(letters.max()) + 1 if len(letters) else 1, 0
    while len(letters) > max(enough, 2):
        level, letters, known = _blocks(letters, known)
        levels.append(level)
        if len(letters) < 2:
            break
        level, letters, known = _pairs(letters, known, round_)
        levels.append(level)
        round_ += 1
    levels.append(Level(letters))
    return levels


def agreement(levels: Sequence[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from positions ``i`` and ``j`` (i < j) on are equal; the last word must be unique."""
    begin, size = i, len(i)
    query = np.arange(size)
    stopped: list[list[tuple[np.ndarray, ...]]] = [[] for _ in levels]
    for t, level in enumerate(levels[:-1]):
        same = level.letters[i] == level.letters[j]
        stopped[t].append((query[~same], i[~same], j[~same]))
        query, i, j = query[same], i[same], j[same]
        inside = (level.first[level.parent[i]] != i) | (level.first[level.parent[j]] != j)
        if level.blocks:
            one, two = level.left(i), level.left(j)
            step = np.where(inside, np.minimum(one, two), 0)
            i, j = i + step, j + step
            apart = inside & (one != two)  # one block goes on where the other ends
            stopped[t].append((query[apart], i[apart], j[apart]))
            query, i, j = query[~apart], i[~apart], j[~apart]
        else:
            i, j = i + inside, j + inside
        i, j = level.parent[i], level.parent[j]
    top = levels[-1].letters
    while len(query):
        same = top[i] == top[j]
        stopped[-1].append((query[~same], i[~same], j[~same]))
        query, i, j = query[same], i[same] + 1, j[same] + 1
    query, i, j = (np.concatenate(x) for x in zip(*stopped[-1])) if stopped[-1] else (query, i, j)
    for t in range(len(levels) - 2, -1, -1):
        level = levels[t]
        i, j = level.first[i], level.first[j]
        same = level.letters[i] == level.letters[j]
        step = np.minimum(level.left(i), level.left(j)) if level.blocks else 1
        step = np.where(same, step, 0)
        i, j = i + step, j + step
        query, i, j = (np.concatenate(x) for x in zip((query, i, j), *stopped[t]))
    out = np.zeros(size, np.int64)
    out[query] = i - begin[query]
    return out


def grid_candidates(x: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid points and periods that may lie in a run; texts of ``sizes`` words, longest first, stand in ``x``."""
    ends = np.cumsum(sizes + 1) + 1
    held, points, periods = 0, [], []
    for q in range(1, int(sizes[0]) // POWERS + 1 if len(sizes) else 0):
        fit = int(np.searchsorted(-sizes, -POWERS * q, side="right"))
        grid = x[: ends[fit - 1] : q]
        same = np.zeros(len(grid) + 6, bool)
        same[2 : len(grid) + 1] = grid[1:] == grid[:-1]
        m = (len(grid) + 2) // 3
        before2, before, at, after, after2 = (same[k : k + 3 * m : 3][:m] for k in range(5))
        hit = np.flatnonzero(at & ((before2 & before) | (before & after) | (after & after2)))
        if len(hit):
            points.append(hit * (3 * q))
            periods.append(np.full(len(hit), q))
            held += len(hit)
            if held >= QUERIES:
                yield np.concatenate(points), np.concatenate(periods)
                held, points, periods = 0, [], []
    if held:
        yield np.concatenate(points), np.concatenate(periods)


def _runs_of_batch(numbers: list[np.ndarray], known: int) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs, by text, start and period; word numbers are 1..known."""
    sizes = np.array([len(x) for x in numbers], np.int64)
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    begin = np.cumsum(sizes + 1) - sizes
    x = np.empty(int(sizes.sum()) + len(sizes) + 1, np.int64)
    separators = np.append(begin - 1, len(x) - 1)
    x[separators] = np.arange(len(separators)) + known + 1
    for at, k in zip(begin, order):
        x[at : at + len(numbers[k])] = numbers[k]
    found, levels = [], None
    for points, periods in grid_candidates(x, sizes):
        if levels is None:
            levels = grammar(x, 2 * len(sizes))
            mirror = [level.mirrored() for level in levels]
        right = agreement(levels, points, points + periods)
        left = agreement(mirror, len(x) - points - periods, len(x) - points)
        length = periods + left + right
        run = length >= np.maximum(SHORTEST, POWERS * periods)
        rows = np.stack([points[run] - left[run], length[run], periods[run]], axis=1)
        found.append(np.unique(rows, axis=0))
    if not found:
        return []
    # A run is also found by the multiples of its period; the smallest comes first.
    rows = np.unique(np.concatenate(found), axis=0)
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[smallest]
    text = np.searchsorted(begin, rows[:, 0], side="right") - 1
    out = zip(order[text], rows[:, 0] - begin[text], rows[:, 1], rows[:, 2])
    return sorted((int(a), int(b), int(c), int(d)) for a, b, c, d in out)


def find_runs(texts: Sequence[Sequence[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start and period; a text is a list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = lambda number=number: len(number) + 1
        part, held, begin = [], 0, at
        while at < len(texts) and (not part or held + len(texts[at]) <= TOGETHER):
            part.append(np.fromiter(map(number.__getitem__, texts[at]), np.int64, len(texts[at])))
            held += len(texts[at])
            at += 1
        for k, start, length, period in _runs_of_batch(part, len(number)):
            out[begin + k].append((start, length, period))
    return out


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words without what any run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept])


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed): the runs of each text's words, and its words without repetitions, one blank between."""
    kind = docs.schema[id_col].dataType.simpleString()
    # bytes.split() parts exactly at blanks and the control characters 9 to 13.
    slim = docs.select(F.col(id_col).alias("id"), F.encode(F.col(text_col).cast("string"), "UTF-8").alias("text"))
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").split() for t in batch.column(1).to_pylist()]
            runs = find_runs(texts)
            rest = pa.array([collapsed(w, r) for w, r in zip(texts, runs)], pa.binary())
            rows = pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs], pa.list_(struct))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows, rest], ["id", "runs", "collapsed"])

    schema = f"id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    out = slim.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), "runs", F.decode("collapsed", "UTF-8").alias("collapsed"))


def with_cyclic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text), where a tenth of the texts (by the hash of the id) goes round in a circle from some word on."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    slim = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), g.alias("g"),
        F.when(h % 10 == 0, words).alias("words"),
    )
    n = F.size("words")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))

    def word(w: Column, i: Column) -> Column:
        return F.when(i < F.col("a"), w).otherwise(
            F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        )

    turned = slim.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    text = F.when(n > 0, F.array_join(F.transform("words", word), " ")).otherwise(F.col("text"))
    return turned.select(F.col("id").alias(id_col), text.alias(text_col))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: number of runs, the one repeated most often, digests of all runs and of the kept words."""
    found = collapse_runs(with_cyclic_tails(docs.select("doc_id", "text")))

    def more(x: Column, y: Column) -> Column:
        gap = y["length"] * x["period"] - x["length"] * y["period"]
        gap = F.when(gap != 0, gap).when(x["start"] != y["start"], x["start"] - y["start"])
        return F.signum(F.coalesce(gap, x["period"] - y["period"])).cast("int")

    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "")
    best = F.get(F.array_sort("runs", more), F.lit(0))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
