"""Removal of long repeated strings by suffix sorting.

A byte goes if some 200-byte string that covers it also starts anywhere else, in the same document or
in another. The work is in four steps, none of which gathers the corpus:

1. **Anchors.** Every 200-byte window elects its leftmost 32-byte gram of the smallest hash. Equal
   windows elect equal grams at equal places, so windows can only repeat within the group of their
   gram. Consecutive windows that elect the same gram form one context: the bytes they cover.
2. **Groups.** Grams that occur once leave. Contexts that occur twice or more are repeated as a whole.
3. **Suffix sorting** of what is left, the distinct contexts of grams with several contexts: in a
   batch of whole groups, the suffixes smaller than their successors are sorted directly; the others
   follow by scanning the buckets of first bytes in order; adjacent windows in that order with common
   prefixes of 200 bytes are repeated. Groups above ``LARGE`` contexts are counted by the hash of
   each window instead, which needs no group in one place.
4. **Cutting.** Each document's repeated windows are united and cut out of its bytes.

Defined results: a null text is empty; texts are read whole, as UTF-8; texts shorter than 200 bytes
keep every byte; repeated rows count as copies of each other; an empty table gives no rows; only the
two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from offerwise.sources.staging import stage

LENGTH = 200
GRAM = 32
BLOCK = 1_000_000  # bytes hashed together; longer documents are read in overlapping blocks
PLACE_BITS = np.uint64(24)
SORTED_BYTES = 1_000_000  # of contexts sorted together
LARGE = 10_000
BROADCAST_ROWS = 1_000_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each place, as one number; past the end they are zero."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded.tobytes(), strides=(1,)).copy()


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the gram that starts at each place."""
    w = _words(data)
    n = len(data) - GRAM + 1
    x = sum((w[8 * i : 8 * i + n] * _ODD[i] for i in range(1, GRAM // 8)), w[:n] * _ODD[0])
    x ^= x >> np.uint64(32)
    x *= _ODD[4]
    return x ^ (x >> np.uint64(29))


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive keys, by doubling."""
    step, out = 1, keys
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    if step < width:
        shift = width - step
        out = np.minimum(out[:-shift], out[shift:])
    return out


def contexts(data: bytes, ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, gram hash) of each context of the documents in ``data`` that end at ``ends``."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, np.zeros(0, np.uint64)
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    places = np.arange(len(hashes), dtype=np.uint64)
    keys = ((hashes >> PLACE_BITS) << PLACE_BITS) | places
    elected = (_window_minima(keys, LENGTH - GRAM + 1) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    valid = np.ones(len(elected), bool)
    for end in ends:
        valid[max(0, end - LENGTH + 1) : end] = False
    elected[~valid] = -1
    first = np.flatnonzero(np.concatenate([[True], elected[1:] != elected[:-1]]))
    last = np.concatenate([first[1:], [len(elected)]]) - 1
    kept = elected[first] >= 0
    first, last = first[kept], last[kept]
    return first, last, hashes[elected[first]]


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Blocks of bytes with (row, place in block, place in document) of each document part in them."""
    data, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text) - LENGTH + 1), BLOCK):
            part = text[start : start + BLOCK + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            data.append(part)
            parts.append((row, size, start))
            size += len(part)
            if size >= BLOCK:
                yield b"".join(data), parts
                data, parts, size = [], [], 0
    if parts:
        yield b"".join(data), parts


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "x", "first", "last", "gram", "context"]
    for batch in batches:
        texts = [(t or "").encode("utf-8", "replace") for t in batch.column(2).to_pylist()]
        found: list[list[np.ndarray]] = [[] for _ in names[2:]]
        rows: list[np.ndarray] = []
        for data, parts in _pieces(texts):
            begins = [place for _, place, _ in parts]
            first, last, grams = contexts(data, [*begins[1:], len(data)])
            part = np.searchsorted(begins, first, side="right") - 1
            shift = np.array([start - place for _, place, start in parts], np.int64)[part]
            hashes = [
                xxh3_64_intdigest(data[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())
            ]
            rows.append(np.array([row for row, _, _ in parts], np.int64)[part])
            for out, x in zip(found, (first + shift, last + shift, grams, np.array(hashes, np.uint64))):
                out.append(x)
        row = np.concatenate([*rows, np.zeros(0, np.int64)])
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int32))
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*x, np.zeros(0, kind)]).astype(kind).view("i8")))
            for x, kind in zip(found, ("i8", "i8", "u8", "u8"))
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names)


def _larger_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is larger than its successor; the last one is."""
    if not len(text):
        return np.zeros(0, bool)
    step = np.concatenate([text[1:].astype(np.int16) - text[:-1], [-1]])
    where = np.where(step != 0, np.arange(len(text)), len(text) - 1)
    nearest = np.minimum.accumulate(where[::-1])[::-1]
    return step[nearest] < 0


def suffix_order(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` bytes at least, by two-stage sorting."""
    n = len(text)
    induced = _larger_than_next(text)
    direct = np.flatnonzero(~induced)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    keys = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(keys).view(f"S{depth}").ravel(), kind="stable")]
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        bucket = waiting[byte]
        new = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
        bucket = []
        while len(new):  # suffixes induced from their own bucket: runs of one byte
            bucket.append(new)
            new = new[new > 0] - 1
            new = new[induced[new] & (text[new] == byte)]
        bucket.append(direct[bounds[byte] : bounds[byte + 1]])
        done = np.concatenate(bucket)
        if not len(done):
            continue
        out.append(done)
        before = done[done > 0] - 1
        before = before[induced[before] & (text[before] != byte)]
        heads = text[before]
        order = np.argsort(heads, kind="stable")
        before, heads = before[order], heads[order]
        cuts = np.flatnonzero(heads[1:] != heads[:-1]) + 1 if len(heads) else []
        for part in np.split(before, cuts) if len(before) else []:
            waiting[text[part[0]]].append(part)
    return np.concatenate([*out, np.zeros(0, np.int64)])


def common_prefixes(text: np.ndarray, order: np.ndarray, longest: int = LENGTH) -> np.ndarray:
    """Whole words of eight bytes that each suffix shares with the one before it, up to ``longest`` bytes."""
    words = _words(np.concatenate([text, np.zeros(longest, np.uint8)]))
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for i in range(0, longest, 8):
        alive = alive[words[order[alive] + i] == words[order[alive - 1] + i]]
        out[alive] = i + 8
    return out


def repeated_windows(texts: list[bytes], windows: list[int]) -> list[np.ndarray]:
    """For each text, which of its first ``windows`` places start a string that starts at another such place too."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    own = np.zeros(len(text) + 1, bool)
    for start, n in zip(starts.tolist(), windows):
        own[start : start + n] = True
    order = suffix_order(text)
    order = order[own[order]]
    same = common_prefixes(text, order) >= LENGTH
    hit = np.zeros(len(text) + 1, bool)
    hit[order[same]] = True
    hit[order[:-1][same[1:]]] = True
    return [hit[s : s + n] for s, n in zip(starts.tolist(), windows)]


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


_RUNS = "gram bigint, context bigint, runs array<struct<a:bigint,b:bigint>>"
_RUN_TYPE = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _run_batch(grams: list, ids: list, hits: list[np.ndarray]) -> pa.RecordBatch:
    runs = [[{"a": a, "b": b} for a, b in _runs(hit)] for hit in hits]
    return pa.RecordBatch.from_arrays(
        [pa.array(grams, pa.int64()), pa.array(ids, pa.int64()), pa.array(runs, _RUN_TYPE)], ["gram", "context", "runs"]
    )


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gram, context, bytes) come sorted by gram; whole groups are sorted together."""
    rows: list[tuple[int, int, bytes]] = []
    size = 0

    def solve(part: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        texts = [x[2] for x in part]
        hits = repeated_windows(texts, [len(t) - LENGTH + 1 for t in texts])
        return _run_batch([x[0] for x in part], [x[1] for x in part], hits)

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if size >= SORTED_BYTES and rows[-1][0] != row[0]:
                yield solve(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[2])
    if rows:
        yield solve(rows)


def _window_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for gram, context, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            n = len(data) - LENGTH + 1
            keys = [xxh3_128_digest(data[i : i + LENGTH]) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([gram] * n, pa.int64()), pa.array([context] * n, pa.int64()), pa.array(range(n), pa.int64()),
                 pa.array(keys, pa.binary())],
                ["gram", "context", "place", "key"],
            )


def _large_groups(rows: DataFrame) -> DataFrame:
    """The same result for groups of any size: windows counted by hash, places as runs of one."""
    keys = stage(rows.mapInArrow(_window_keys, "gram bigint, context bigint, place bigint, key binary"), "repeat-windows")
    twice = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    place = F.struct(F.col("place").alias("a"), F.col("place").alias("b"))
    return keys.join(twice, "key", "left_semi").groupBy("gram", "context").agg(F.collect_list(place).alias("runs"))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast only what was counted and is small; anything larger is shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gram, context, data = [], [], []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = (text or "").encode("utf-8", "replace")
            for w in wanted:
                gram.append(w["gram"])
                context.append(w["context"])
                data.append(raw[w["first"] : w["last"] + LENGTH])
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64()), pa.array(context, pa.int64()), pa.array(data, pa.binary())],
            ["gram", "context", "data"],
        )


def repeated(slim: DataFrame) -> DataFrame:
    """(id, x, spans): intervals of repeated window starts, for the documents (id, x, text) that have any."""
    zipped = F.explode(F.arrays_zip("first", "last", "gram", "context")).alias("w")
    found = slim.mapInArrow(
        _anchor_batches,
        f"id {slim.schema['id'].dataType.simpleString()}, x bigint, first array<bigint>, last array<bigint>, "
        "gram array<bigint>, context array<bigint>",
    ).withColumn("rid", F.monotonically_increasing_id())
    found = stage(found, "repeat-anchors")
    anchors = found.select("rid", zipped).select("rid", "w.*")
    grams = (
        anchors.groupBy("gram")
        .agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
        .where("n > 1")
        .select("gram", (F.col("low") != F.col("high")).alias("mixed"))
    )
    grams = stage(grams, "repeat-grams")
    met = stage(anchors.join(_small(grams), "gram"), "repeat-met")
    # One occurrence of each distinct context of the mixed groups.
    distinct = (
        met.where("mixed")
        .groupBy("gram", "context")
        .agg(F.count("*").alias("n"), F.min(F.struct("rid", "first", "last")).alias("at"))
    )
    distinct = stage(distinct.select("gram", "context", "n", "at.*"), "repeat-contexts")
    single = distinct.where("n = 1").select("gram").distinct()
    asked = distinct.join(single, "gram", "left_semi")
    wanted = (
        asked.groupBy("rid")
        .agg(F.collect_list(F.struct("gram", "context", "first", "last")).alias("wanted"))
        .join(found.select("rid", "id", "x"), "rid")
        .dropDuplicates(["rid"])
        .select(F.col("id").alias("wanted_id"), F.col("x").alias("wanted_x"), "wanted", "rid")
    )
    wanted = stage(wanted, "repeat-wanted")
    ids = wanted.select("wanted_id", "wanted_x").distinct()
    here = F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("x") == F.col("wanted_x"))
    some = slim.join(_small(ids), here, "left_semi").dropDuplicates(["id", "x"])
    data = some.join(wanted, here).select("text", "wanted")
    data = stage(data.mapInArrow(_cut_contexts, "gram bigint, context bigint, data binary"), "repeat-data")
    large = data.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select("gram")
    large = stage(large, "repeat-large")
    n_large = large.count()
    hint = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
    spread = data.join(hint, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    runs = spread.mapInArrow(_sort_groups, _RUNS)
    if n_large:
        runs = runs.unionByName(_large_groups(data.join(hint, "gram", "left_semi")))
    runs = stage(runs, "repeat-runs")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("last") - F.col("first")).alias("b")))
    # One decision for each context, so that its occurrences, however many, are joined once.
    known = distinct.join(runs, ["gram", "context"], "left").select("gram", "context", (F.col("n") > 1).alias("copied"), "runs")
    partly = met.where("mixed").join(stage(known, "repeat-known"), ["gram", "context"])
    spans = met.where("not mixed").select("rid", "first", whole.alias("runs")).unionByName(
        partly.select("rid", "first", F.when(F.col("copied"), whole).otherwise(F.col("runs")).alias("runs"))
    )
    moved = F.transform("runs", lambda r: F.struct((r["a"] + F.col("first")).alias("a"), (r["b"] + F.col("first")).alias("b")))
    return (
        spans.where("size(runs) > 0")
        .groupBy("rid")
        .agg(F.flatten(F.collect_list(moved)).alias("spans"))
        .join(found.select("rid", "id", "x"), "rid")
        .dropDuplicates(["id", "x"])
        .select("id", "x", "spans")
    )


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes that no repeated window covers, and the number of maximal removed runs."""
    kept, n, done, open_ = [], 0, 0, False
    for a, b in sorted(spans):
        if not open_ or a > done:
            kept.append(data[done:a])
            n += 1
            open_ = True
        done = max(done, b + LENGTH)
    kept.append(data[done:])
    return b"".join(kept), n


def _marked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, x, text) of the documents, and the spans by (id, x)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("x"), text.alias("text"))
    return slim, repeated(slim)


def _spans(x) -> list[tuple[int, int]]:
    return [(s["a"], s["b"]) for s in x or ()]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans and the digest of the bytes that stay."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim, spans = _marked(docs, id_col, text_col)
    spans = spans.select(F.col("id").alias("of"), F.col("x").alias("of_x"), "spans")
    joined = slim.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("x") == F.col("of_x")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode("utf-8", "replace")
                left, n = cut(raw, _spans(found))
                out.append((len(raw), len(raw) - len(left), n, hashlib.sha256(left).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.select("id", "text", "spans").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of every text.

    A cut inside a character takes the rest of that character as well; null texts stay null.
    """
    _, spans = _marked(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    of = F.col(id_col).eqNullSafe(F.col("__of")) & (F.xxhash64(text) == F.col("__of_x"))
    marked = docs.join(
        spans.select(F.col("id").alias("__of"), F.col("x").alias("__of_x"), F.col("spans").alias("__spans")), of, "left"
    ).drop("__of", "__of_x")
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if t is None else cut(t.encode("utf-8", "replace"), _spans(s))[0].decode("utf-8", "ignore")
                for t, s in zip(batch.column(at).to_pylist(), batch.column("__spans").to_pylist())
            ]
            columns = [batch.column(i) if i != at else pa.array(texts, pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return marked.select(*names, "__spans").mapInArrow(run, docs.schema)
