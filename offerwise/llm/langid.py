"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's probability is
the sum over all its segmentations into pieces, computed by the forward algorithm; a text's is the
product over its words. The piece probabilities are fitted by expectation maximisation on a bounded
sample of labelled documents: at most ``SAMPLE_DOCS`` whole documents of each language, those with the
smallest hash of their id. The word counts of the sample, the expected piece counts and the scoring
are Spark jobs; the driver sees one number for each piece and language.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text
where no labelled row was given; texts are scored whole; ties go to the first language by name;
repeated rows give one row each; only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from offerwise.sources.staging import stage

UNKNOWN = "und"
SAMPLE_DOCS = 250
SHARES = 16  # parts of a language that are ranked apart first
ROUNDS = 2
SMOOTHING = 0.1
LONGEST_PIECE = 12
LONGEST_WORD = 30  # longer runs of letters are scored in parts, which keeps products above zero
OTHER_CHAR = 1e-7  # a character that no piece covers, in every language alike
MEMORY = 500_000  # words a worker remembers; beyond that it starts anew
TOGETHER = 8_000  # new words scored together

WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, each at most ``LONGEST_WORD`` long, with the vocabulary's word mark."""
    out = WORDS.findall(text.lower())
    if len(out) and max(map(len, out)) > LONGEST_WORD:
        out = [w[i : i + LONGEST_WORD] for w in out for i in range(0, len(w), LONGEST_WORD)]
    return out


def pieces_of(path: str) -> list[str]:
    """The vocabulary's pieces, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    ids = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return sorted({p for p in map(sp.id_to_piece, ids) if len(p) <= LONGEST_PIECE})


def forward(word: str, table: dict[str, tuple[float, ...]], width: int) -> list[list[float]]:
    """Row j: for each of ``width`` models the summed probability of all segmentations of the first j characters."""
    none = (0.0,) * width
    alpha = [[1.0] * width]
    for j in range(1, len(word) + 1):
        total: list[float] | None = None
        for i in range(max(0, j - LONGEST_PIECE), j):
            if (p := table.get(word[i:j])) is not None:
                a = alpha[i]
                if total is None:
                    total = [x * y for x, y in zip(a, p)]
                else:
                    total = [t + x * y for t, x, y in zip(total, a, p)]
        if word[j - 1] not in table:
            a = alpha[j - 1]
            total = [t + x * OTHER_CHAR for t, x in zip(total or none, a)]
        alpha.append(total)
    return alpha


def expected(word: str, n: float, p: dict[str, float], out: Counter) -> None:
    """Adds to ``out`` how often each piece is used in ``n`` copies of ``word``, over all segmentations."""
    table = {}
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - LONGEST_PIECE), j):
            if (x := p.get(word[i:j])) is not None:
                table[word[i:j]] = (x,)
    alpha = [row[0] for row in forward(word, table, 1)]
    size = len(word)
    beta = [0.0] * size + [1.0]
    for i in range(size - 1, -1, -1):
        for j in range(i + 1, min(size, i + LONGEST_PIECE) + 1):
            if (x := table.get(word[i:j])) is not None:
                beta[i] += x[0] * beta[j]
        if word[i] not in table:
            beta[i] += OTHER_CHAR * beta[i + 1]
    whole = alpha[size]
    for i in range(size):
        for j in range(i + 1, min(size, i + LONGEST_PIECE) + 1):
            if (x := table.get(word[i:j])) is not None:
                out[word[i:j]] += n * alpha[i] * x[0] * beta[j] / whole


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update((lang, "▁" + w) for w in words_of(text or ""))
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k, _ in rows], pa.string()),
                pa.array([k[1] for k, _ in rows], pa.string()),
                pa.array([n for _, n in rows], pa.int64()),
            ],
            ["lang", "word", "n"],
        )


def sample_words(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, word, n) of the bounded sample of labelled documents that are not held out.

    Documents are ranked in hash shares of a language first, so that the task of a language sees
    ``SHARES * sample_docs`` of them however many there are.
    """
    labelled = docs.where(~held_out() & F.col("lang").isNotNull())
    order = F.xxhash64("doc_id"), F.col("doc_id")
    ids = labelled.select("doc_id", "lang").distinct().withColumn("share", F.pmod(order[0], F.lit(SHARES)))
    chosen = ids
    for keys in (("lang", "share"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= sample_docs).select("doc_id", "lang", "share")
    # sample_docs rows for each language: a proven bound.
    texts = labelled.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")
    counts = texts.mapInArrow(_count, "lang string, word string, n bigint")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hash(piece: str) -> int:
    out = 0
    for c in piece:
        out = (out * int(_FACTOR) + ord(c) + 1) % 2**64
    return out


class Model:
    """Piece probabilities, a row for each piece and a column for each language, and scores of known words."""

    def __init__(self, langs: list[str], pieces: list[str], table: np.ndarray) -> None:
        self.langs, self.pieces, self.table = langs, pieces, table
        # Hashes of all pieces and of all that only begins a piece, sorted; -1 stands for the latter.
        numbers = {p[:i]: -1 for p in pieces for i in range(1, len(p))}
        numbers.update({p: i for i, p in enumerate(pieces)})
        keys = np.array([_hash(p) for p in numbers], np.uint64)
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], np.array(list(numbers.values()), np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.probability = np.concatenate([table, np.full((1, len(langs)), OTHER_CHAR)]) if langs else table
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(langs)))

    def __reduce__(self) -> tuple:
        return Model, (self.langs, self.pieces, self.table)

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """The forward algorithm for all words and languages at once: a row for each word."""
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        width = LONGEST_WORD + 1
        chars = "".join(("▁" + w).ljust(width, "\0") for w in words).encode("utf-32-le")
        chars = np.frombuffer(chars, "<u4").astype(np.uint64)
        row = np.repeat(np.arange(len(words)), sizes)
        start = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hashes = np.zeros(len(row), np.uint64)
        found = []
        for length in range(1, LONGEST_PIECE + 1):
            inside = start + length <= sizes[row]
            row, start, hashes = row[inside], start[inside], hashes[inside]
            if not len(row):
                break
            hashes = hashes * _FACTOR + chars[row * width + start + length - 1] + np.uint64(1)
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            known = self.keys[at] == hashes
            piece = np.where(known, self.numbers[at], -1)
            if length == 1:
                piece = np.where(piece < 0, len(self.pieces), piece)
            hit = piece >= 0
            found.append((row[hit], start[hit], start[hit] + length, piece[hit]))
            row, start, hashes = row[known], start[known], hashes[known]
        row, start, end, piece = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
        order = np.argsort(end, kind="stable")
        piece, end, start, row = piece[order], end[order], start[order], row[order]
        alpha = np.zeros((len(self.langs), LONGEST_WORD + 2, len(words)))
        alpha[:, 0] = 1.0
        bounds = np.searchsorted(end, np.arange(LONGEST_WORD + 3))
        for j in range(1, LONGEST_WORD + 2):
            at = slice(bounds[j], bounds[j + 1])
            for k in range(len(self.langs)):
                used = alpha[k, start[at], row[at]] * self.probability[piece[at], k]
                alpha[k, j] = np.bincount(row[at], used, len(words))
        return np.log(np.maximum(alpha[:, sizes, np.arange(len(words))].T, 1e-300))

    def _learn(self, words: list[str]) -> None:
        for i in range(0, len(words), TOGETHER):
            part = words[i : i + TOGETHER]
            self.rows.update(zip(part, range(len(self.rows), len(self.rows) + len(part))))
            self.scores = np.concatenate([self.scores, self.log_probabilities(part)])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        found = [words_of(t or "") for t in texts]
        if self.langs:
            words = {w for words in found for w in words}
            if len(self.rows) + len(words) > MEMORY:
                self.rows, self.scores = {}, self.scores[:0]
            self._learn(list(words.difference(self.rows)))
        out = []
        for words in found:
            if not self.langs or not any(any(map(str.isalpha, w)) for w in words):
                out.append((UNKNOWN, 0.0))
                continue
            total = self.scores[list(map(self.rows.__getitem__, words))].sum(axis=0)
            best = int(total.argmax())
            out.append((self.langs[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def fit(docs: DataFrame, vocabulary: str, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> Model:
    """Expectation maximisation from equal piece probabilities, pieces by language summed in Spark."""
    spark = docs.sparkSession
    words = stage(sample_words(docs, sample_docs), "langid-words")
    langs = sorted(row[0] for row in words.select("lang").distinct().collect())
    pieces = pieces_of(vocabulary)
    at = {p: i for i, p in enumerate(pieces)}
    prob = np.full((len(langs), len(pieces)), 1.0 / len(pieces))  # 8 bytes a piece and language
    for _ in range(rounds if langs else 0):
        now = spark.sparkContext.broadcast((langs, pieces, prob))

        def count(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums: dict[str, Counter] = {}
            known: dict[str, dict[str, float]] = {}
            names, parts, table = now.value
            for batch in batches:
                for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if lang not in known:
                        known[lang] = dict(zip(parts, table[names.index(lang)].tolist()))
                    expected(word, n, known[lang], sums.setdefault(lang, Counter()))
            rows = [(lang, piece, x) for lang, counts in sums.items() for piece, x in counts.items()]
            kinds = (pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["lang", "piece", "x"]
            )

        spread = words.repartition(spark.sparkContext.defaultParallelism, "lang", "word")
        sums = spread.mapInArrow(count, "lang string, piece string, x double").groupBy("lang", "piece").agg(F.sum("x"))
        got = np.full(prob.shape, SMOOTHING)
        row = {lang: i for i, lang in enumerate(langs)}
        for lang, piece, x in sums.collect():  # at most the fixed vocabulary for each language
            got[row[lang], at[piece]] += x
        prob = got / got.sum(axis=1, keepdims=True)
        now.unpersist()
    return Model(langs, pieces, np.ascontiguousarray(prob.T))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred and score."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found])],
                ["id", "lang_pred", "score"],
            )

    return slim.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def with_prediction(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns lang_pred and score added, in place of any that it has of these names."""
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch.column(at).to_pylist())
            more = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Fit on the labelled rows that are not held out, then predict every row."""
    slim = docs.select("doc_id", "text", "lang")
    out = predict(slim, fit(slim, vocabulary))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
