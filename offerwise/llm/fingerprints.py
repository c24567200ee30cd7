"""Document fingerprints by invertible Bloom lookup sketches.

A text is a set of paragraph digests: 64-bit hashes of its sentences (a line's, or, where a line has
no sentence ends, parts cut at words whose hash says so, and where it has no blanks either, at pairs of
characters whose hash says so), the second and later copies of a paragraph
counted as paragraphs of their own. Digests are summed into cells at three hashed places each, with a
count and a checksum sum. The difference of two sketches holds only the paragraphs that differ;
peeling cells that hold exactly one recovers them. Where peeling gets stuck, both texts are sketched
anew with more cells, until it ends. The likeness is the exact Jaccard index that follows.

All documents of an Arrow batch are sketched, subtracted and peeled together in flat numpy arrays.

Defined results: a null text is an empty text; two empty texts have likeness 1, an empty and another
one 0; texts are read whole; repeated rows and repeated ids follow each other in the order of id, then
text, null ids first; a single document is its own successor; an empty table gives no rows; ids are
whole numbers; only the two named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

SUBTABLES = 3
BASE_CELLS = 4  # of each subtable of the fingerprint that is returned
LONG_PARAGRAPH = 64

# Sentence ends of several scripts: full stops, exclamation and question marks.
_ENDS = re.compile(r"(?<=[.!?\n。！？｡．।॥؟۔።])[ \t]*")
_WORD = re.compile(r"\S+\s*")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_CHECK = 0xD6E8FEB86659FD93


def _pieces(word: str) -> list[str]:
    """A run without blanks, cut after the characters that, with the one before, have a hash divisible by 8."""
    if len(word) <= LONG_PARAGRAPH:
        return [word]
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashed = _mixed(codes[:-1] << np.uint64(32) | codes[1:], _CHECK)
    cuts = [0, *(np.flatnonzero(hashed % np.uint64(8) == 0) + 2).tolist(), len(word)]
    return [word[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


def paragraphs(text: str) -> list[str]:
    """The text cut into paragraphs; joined again they differ from it at most in blanks."""
    out = []
    for part in _ENDS.split(text):
        if len(part) <= LONG_PARAGRAPH:
            if part and not part.isspace():
                out.append(part)
            continue
        piece = []
        for word in (x for run in _WORD.findall(part) for x in _pieces(run)):
            piece.append(word)
            if zlib.crc32(word.rstrip().encode("utf-8", "replace")) % 5 == 0:
                out.append("".join(piece))
                piece = []
        if piece:
            out.append("".join(piece))
    return out


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit paragraph digests; the n-th copy of a paragraph has a digest of its own."""
    found = [xxh3_64_intdigest(p) for p in paragraphs(text)]
    if len(set(found)) < len(found):
        seen: dict[int, int] = {}
        for i, x in enumerate(found):
            n = seen[x] = seen.get(x, 0) + 1
            if n > 1:
                found[i] = xxh3_64_intdigest(x.to_bytes(8, "little"), n)
    return np.array(found, dtype=np.uint64)


def _mixed(keys: np.ndarray, factor: int) -> np.ndarray:
    x = keys * np.uint64(factor)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Sketches:
    """One sketch for each owner, of ``cells[owner]`` cells in each subtable, in flat arrays."""

    def __init__(self, cells: np.ndarray, salt: int) -> None:
        self.cells = cells.astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.cells * SUBTABLES)])
        self.salt = np.uint64(salt * 0x2545F4914F6CDD1D % 2**64)
        size = int(self.starts[-1])
        self.count = np.zeros(size, np.int64)
        self.key = np.zeros(size, np.uint64)
        self.check = np.zeros(size, np.uint64)

    def _places(self, owners: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
        cells, first = self.cells[owners], self.starts[owners]
        mask = (cells - 1).astype(np.uint64)
        return [
            first + r * cells + (_mixed(keys ^ self.salt, factor) & mask).astype(np.int64)
            for r, factor in enumerate(_MIX)
        ]

    def add(self, owners: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> None:
        """Add (sign 1) or subtract (sign -1) keys; the number of cells must be a power of two."""
        sign = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        signed = sign.astype(np.uint64)
        key, check = keys * signed, _mixed(keys, _CHECK) * signed
        for places in self._places(owners, keys):
            np.add.at(self.count, places, sign)
            np.add.at(self.key, places, key)
            np.add.at(self.check, places, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recovered (owners, keys, signs), and for each owner whether nothing is left."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            keys = self.key[look] * sign.astype(np.uint64)
            pure = (np.abs(sign) == 1) & (_mixed(keys, _CHECK) * sign.astype(np.uint64) == self.check[look])
            look, keys, sign = look[pure], keys[pure], sign[pure]
            owners = np.searchsorted(self.starts, look, side="right") - 1
            at_home = np.zeros(len(look), bool)
            for places in self._places(owners, keys):
                at_home |= places == look
            owners, keys, sign = owners[at_home], keys[at_home], sign[at_home]
            if not len(keys):
                break
            order = np.lexsort((keys, owners))
            owners, keys, sign = owners[order], keys[order], sign[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
            owners, keys, sign = owners[new], keys[new], sign[new]
            self.add(owners, keys, -sign)
            found.append((owners, keys, sign))
            touched = np.unique(np.concatenate(self._places(owners, keys)))
            look = touched[np.abs(self.count[touched]) == 1]
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        open_cells = np.concatenate([[0], np.cumsum(left)])
        done = open_cells[self.starts[1:]] == open_cells[self.starts[:-1]]
        if not found:
            empty = np.zeros(0, np.int64)
            return empty, np.zeros(0, np.uint64), empty, done
        return (*(np.concatenate(x) for x in zip(*found)), done)


def _power(x: np.ndarray) -> np.ndarray:
    """The smallest powers of two that are not smaller."""
    return (2 ** np.ceil(np.log2(np.maximum(x, 1)))).astype(np.int64)


def differences(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list]:
    """For each pair of digest sets: how many are only in the first, only in the second, and the recovered rows.

    The first try uses the cells of the fingerprints; a pair that gets stuck is sketched anew with
    cells in proportion to its digests, then twice as many, and so on.
    """
    n = len(a)
    only_a, only_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
    recovered: list = []
    todo = np.arange(n)
    na, nb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    attempt = 0
    while len(todo):
        both = (na + nb)[todo]
        cells = np.full(len(todo), BASE_CELLS) if not attempt else _power(both * 2.0 ** (attempt - 3))
        sketches = Sketches(np.maximum(cells, BASE_CELLS), attempt)
        for sets, sizes, sign in ((a, na, 1), (b, nb, -1)):
            keys = np.concatenate([sets[i] for i in todo] or [np.zeros(0, np.uint64)])
            sketches.add(np.repeat(np.arange(len(todo)), sizes[todo]), keys, sign)
        owners, keys, signs, done = sketches.peel()
        good = done[owners]
        owners, keys, signs = todo[owners[good]], keys[good], signs[good]
        only_a += np.bincount(owners[signs > 0], minlength=n)
        only_b += np.bincount(owners[signs < 0], minlength=n)
        recovered.append((owners, keys, signs))
        todo = todo[~done]
        attempt += 1
    return only_a, only_b, recovered


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Jaccard index of each pair of digest sets, from what peeling their sketches recovers."""
    only_a, only_b, _ = differences(a, b)
    union = np.array([len(x) for x in a]) + only_b
    return np.where(union > 0, (union - only_a - only_b) / np.maximum(union, 1), 1.0)


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    """The base sketches: number of digests, then counts and key sums of all cells."""
    sketches = Sketches(np.full(len(sets), BASE_CELLS), 0)
    owners = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    sketches.add(owners, np.concatenate([*sets, np.zeros(0, np.uint64)]), 1)
    width = BASE_CELLS * SUBTABLES
    counts = sketches.count.astype("<u2").reshape(-1, width)
    keys = sketches.key.astype("<u8").reshape(-1, width)
    return [
        f"{len(x)}:{base64.b64encode(c.tobytes() + k.tobytes()).decode()}" for x, c, k in zip(sets, counts, keys)
    ]


def edited(text: str, other: str) -> str:
    """``text`` with its last quarter of code points replaced by as many first ones of ``other``."""
    n = len(text) // 4
    return text[: len(text) - n] + other[:n]


SCHEMA = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["id", *(x.split()[0] for x in SCHEMA.split(", "))]


def _compare(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    """Result rows of all but the last of (bucket, tail, id, text, digests); tails only follow."""
    pairs = [(x, y) for x, y in zip(rows, rows[1:]) if x[0] == y[0] and not x[1]]
    own = [x[4] for x, _ in pairs]
    changed = [edited(x[3], y[3]) for x, y in pairs]
    sets = [digests(t) for t in changed]
    columns = [
        pa.array([x[2] for x, _ in pairs], id_type),
        pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed], pa.string()),
        pa.array(fingerprints(own), pa.string()),
        pa.array(fingerprints(sets), pa.string()),
        pa.array(likeness(own, sets), pa.float64()),
        pa.array(likeness(own, [y[4] for _, y in pairs]), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carried: list[tuple] = []
    for batch in batches:
        id_type = batch.column(2).type
        bucket, tail, ids, texts = (batch.column(i).to_pylist() for i in range(4))
        rows = carried + [(g, t, i, x, digests(x)) for g, t, i, x in zip(bucket, tail, ids, texts)]
        if len(rows) > 1:
            yield _compare(rows, id_type)
        carried = rows[-1:]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, compared with its edited text and with the next document.

    Ids are cut into ranges of about equal numbers of rows, more than there are tasks, at approximate
    quantiles, and each range is sorted in one task. Rows with a range's first id are sent to the range
    before as well, where they only serve as successors, so the texts are shuffled once.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * tasks
    steps = [(i + 1) / buckets for i in range(buckets - 1)]
    found = slim.agg(F.percentile_approx(F.col("id").cast("long"), steps, max(10_000, 4 * buckets))).first()[0]
    borders = sorted(set(found or []))
    # Null ids come first, in the range below all borders.
    bucket = F.coalesce(F.size(F.filter(F.lit(borders), lambda b: b <= F.col("id"))), F.lit(0)) if borders else F.lit(0)
    keyed = slim.select("*", bucket.alias("bucket"))
    # One row for each range: at most four for each task.
    first = F.min(F.struct(F.col("id").isNotNull().alias("known"), F.col("id").cast("long").alias("id")))
    firsts = keyed.groupBy("bucket").agg(first["id"].alias("id")).orderBy("bucket").collect()
    before = [(firsts[i - 1]["bucket"], row["id"]) for i, row in enumerate(firsts)]
    tails = F.broadcast(spark.createDataFrame(before, "before int, first bigint"))
    again = keyed.join(tails, F.col("id").eqNullSafe(F.col("first"))).select("id", "text", F.col("before").alias("bucket"))
    both = keyed.select("bucket", F.lit(False).alias("tail"), "id", "text").unionByName(
        again.select("bucket", F.lit(True).alias("tail"), "id", "text")
    )
    sorted_ = both.repartition(tasks, "bucket").sortWithinPartitions("bucket", "tail", "id", "text")
    out = sorted_.select("bucket", "tail", "id", "text").mapInArrow(_run, f"id {kind}, {SCHEMA}")
    return out.withColumnRenamed("id", id_col)
