"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

A text becomes ``FEATURES``, each a rate or a damped count over the whole text: words of each kind of lexicon,
their nearness to words of address (second person), capitals, punctuation, and words of the lexicon written
with signs, stretched or spaced letters. One kind of lexicon is learned: whole words and beginnings of words
that stand in clearly more toxic than clean texts of the sample, at most ``LEARNED`` of them. A text of the sample
gets its features from the lexicon of the other half, so the trees see it as it works on new texts; near
copies are in one half and count once.

MLlib's boosted trees are fitted on labelled rows that are not held out, about ``SAMPLE_ROWS`` of them at most by
the hash of the id; a fifth of the sample is kept from the trees and fits the isotonic curve that turns their
probability into a share of toxic rows. Features are computed where the text lies, without shuffle; the ids of
the sample and the lexicons are all that is broadcast.

Defined results: null and empty texts have the features of no words and get the score of such; texts are
taken whole; repeated rows give one row each; a null id is held in and has no label; where an id has several
labels the largest counts, null labels count for nothing; without labelled rows, or with labels of one kind, every
score is the share of toxic ones (0 without any); only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.sources.staging import stage

# Words of abuse by kind, in English, German, French and Spanish.
LEXICON = {
    "insult": (
        "idiot idiots moron morons imbecile loser losers fool fools clown clowns scum trash garbage vermin filth "
        "jerk bastard bastards creep freak pig pigs rat rats parasite coward liar dimwit halfwit dunce "
        "idioten trottel dummkopf schwein arschloch abschaum versager penner depp missgeburt "
        "imbécile crétin abruti salaud ordure raclure connard minable "
        "idiota imbécil estúpido basura escoria cerdo payaso perdedor gilipollas cabrón"
    ).split(),
    "contempt": (
        "stupid dumb pathetic worthless disgusting filthy useless brainless ugly vile despicable revolting "
        "repulsive ridiculous hopeless ignorant retarded hate hateful sickening "
        "dumm blöd erbärmlich wertlos widerlich ekelhaft nutzlos hässlich "
        "stupide pathétique dégoûtant dégueulasse inutile moche répugnant "
        "estúpida patético asqueroso inútil feo repugnante despreciable"
    ).split(),
    "profanity": (
        "fuck fucking fucker shit shitty bullshit crap damn bitch asshole dick whore slut piss "
        "scheiße scheisse verdammt fick hure "
        "merde putain salope enculé "
        "mierda puta joder coño"
    ).split(),
    "threat": (
        "kill die murder rape strangle stab shoot hang burn destroy choke slaughter "
        "töten umbringen sterben verrecken erschießen "
        "tuer crever mourir égorger "
        "matar morir muere degollar"
    ).split(),
}
# Words of address.
ADDRESS = (
    "you your yours yourself u ur du dich dir dein deine euch euer ihr tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros"
).split()
# Signs that stand for letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "#": ""})

NEAR = 5  # words between abuse and a word of address that count as near
FEATURES = (
    *[f"{kind}_rate" for kind in LEXICON],
    *[f"{kind}_count" for kind in LEXICON],
    "kinds", "distinct", "near_rate", "near_share", "address_rate", "capital_letters", "capital_words", "loud_abuse",
    "exclamations", "questions", "repeated_marks", "other_marks", "obfuscated_rate", "obfuscated_count", "mixed_words",
    "words", "learned_rate", "learned_count", "learned_weight", "learned_distinct",
)
MEMORY = 500_000  # words whose weight a worker remembers; beyond that it starts anew
LEARNED = 2_000
BEGINNINGS = (4, 5, 6)  # letters
LEAST_TEXTS = 5  # toxic texts an entry of the learned lexicon stands in, and
CLEAR = 2.5  # the deviations by which its log odds exceed LEAST_ODDS
LEAST_ODDS = 1.0
SAMPLE_ROWS = 20_000
HELD_FOR_CURVE = 5  # one in so many sampled rows fits the curve
PARAMS = {"maxIter": 30, "maxDepth": 4, "stepSize": 0.2, "maxBins": 32, "minInstancesPerNode": 5, "seed": 7}
THRESHOLD = 0.7

# Words are split in UTF-8: everything in ASCII but letters parts them, and so do the marks and blanks below.
_NO_LETTER = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_WIDE_MARK = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f\uff00-\uff0f]")
_SIGN = re.compile(r"[0-9@$*#!]")
_INSIDE = re.compile(r"[^\W_](?:[^\W_]|[@$!*#])*[^\W_]")
_STRETCHED = re.compile(r"([a-z])\1\1+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ ._-]){3,}[^\W\d_](?![^\W_])")
_REPEATED_MARKS = re.compile(r"[!?]{2,}")
_LOUD = re.compile(rb"(?<![A-Za-z\x80-\xff])[A-Z]{2,}(?![A-Za-z\x80-\xff])")


def _around(text: str, at: int, end: int) -> tuple[int, int]:
    """The bounds of what stands between blanks around [at, end)."""
    while at > 0 and not text[at - 1].isspace():
        at -= 1
    while end < len(text) and not text[end].isspace():
        end += 1
    return at, end


def words_of(low: str) -> list[bytes]:
    """The words of a text in lower case, in UTF-8."""
    clean = _WIDE_MARK.sub(" ", low) if not low.isascii() and _WIDE_MARK.search(low) else low
    return clean.encode().translate(_NO_LETTER).split()


def entries_of(word: bytes) -> list[str]:
    """What of a word the learned lexicon may hold: the word, and its beginnings with a mark after them."""
    w = word.decode()
    return [w, *[w[:n] + "-" for n in BEGINNINGS if len(w) > n]]


class Extractor:
    """Features of a text for one fixed lexicon and a learned one (entry -> weight)."""

    def __init__(self, lexicon: Mapping[str, list[str]] = LEXICON, learned: Mapping[str, float] | None = None) -> None:
        self.learned = learned or {}
        self.weights: dict[bytes, float] = {}
        self.kinds = list(lexicon)
        self.kind = {w.encode(): k for k, words in enumerate(lexicon.values()) for w in words}
        self.address = frozenset(w.encode() for w in ADDRESS)
        self.watched = self.address | set(self.kind)

    def weight(self, word: bytes) -> float:
        """The largest weight of the word's entries in the learned lexicon, 0 without any."""
        out = self.weights.get(word)
        if out is None:
            if len(self.weights) > MEMORY:
                self.weights.clear()
            out = self.weights[word] = max((self.learned.get(e, 0.0) for e in entries_of(word)), default=0.0)
        return out

    def _tokens(self, text: str, pattern: re.Pattern) -> list[str]:
        """What stands between blanks around each match, once each."""
        out, done = [], 0
        for m in pattern.finditer(text):
            if m.start() >= done:
                at, done = _around(text, m.start(), m.end())
                out.append(text[at:done])
        return out

    def disguised(self, text: str, stretched: bool, spaced: bool) -> tuple[list[bytes], int]:
        """Words of the lexicon behind signs, stretched or spaced letters; and how many words mix letters with signs."""
        found, mixed = [], 0
        for token in self._tokens(text, _SIGN):
            for w in _INSIDE.findall(token):
                if any(map(str.isalpha, w)) and not w.isalpha():
                    mixed += 1
                    found.append(w.translate(SIGNS))
        for token in self._tokens(text, _STRETCHED) if stretched else ():
            found += [w for w in _INSIDE.findall(token) if w.isalpha() and w.encode() not in self.kind]
        if spaced:
            for row in ("".join(filter(str.isalpha, w)) for w in _SPACED.findall(text)):
                # Letters of one-letter words may stand before and after the word.
                parts = (row[i : i + n] for i in range(len(row) - 3) for n in range(4, min(len(row) - i, 16) + 1))
                found += [x for x in parts if x.encode() in self.kind][:1]
        forms = [[x.encode() for x in (w, _STRETCHED.sub(r"\1", w), _STRETCHED.sub(r"\1\1", w))] for w in found]
        return [x for x in (next((x for x in f if x in self.kind), None) for f in forms) if x], mixed

    def features(self, text: str) -> list[float]:
        low = text.lower()
        words = words_of(low)
        seen = [(i, w) for i, w in enumerate(words) if w in self.watched]
        hits = [(i, w) for i, w in seen if w in self.kind]
        address = [i for i, w in seen if w in self.address]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        spaced = b"\1\1\1\1" in np.minimum(sizes, 2).astype(np.uint8).tobytes()
        signs = np.frombuffer(low.encode(), np.uint8)
        same = signs[1:] == signs[:-1]
        stretched = bool((same[1:] & same[:-1] & (signs[2:] >= ord("a")) & (signs[2:] <= ord("z"))).any())
        hidden, mixed = self.disguised(low, stretched, spaced)
        counts = [0] * len(self.kinds)
        for w in [w for _, w in hits] + hidden:
            counts[self.kind[w]] += 1
        near = 0
        if hits and address:
            at, to = np.array([i for i, _ in hits]), np.array(address)
            place = np.searchsorted(to, at)
            before = at - to[np.maximum(place - 1, 0)]
            after = to[np.minimum(place, len(to) - 1)] - at
            near = int(np.count_nonzero(((before >= 0) & (before <= NEAR)) | ((after >= 0) & (after <= NEAR))))
        n, size = max(len(words), 1), max(len(text), 1)
        raw = text.encode()
        capitals = len(raw) - len(raw.translate(None, _CAPITALS))
        loud = _LOUD.findall(raw) if capitals > 1 else []
        marks = text.count("!"), text.count("?")
        total = sum(counts)
        weights = {w: x for w in set(words) if (x := self.weight(w)) > 0.0} if self.learned else {}
        learned = sum(n for w, n in Counter(words).items() if w in weights) if weights else 0
        return [
            *[100.0 * c / n for c in counts],
            *[math.log1p(c) for c in counts],
            float(sum(c > 0 for c in counts)),
            math.log1p(len({w for _, w in hits} | set(hidden))),
            100.0 * near / n,
            near / total if total else 0.0,
            100.0 * len(address) / n,
            capitals / max(int(sizes.sum()), 1),
            100.0 * len(loud) / n,
            float(sum(w.lower() in self.kind for w in loud)),
            100.0 * marks[0] / size,
            100.0 * marks[1] / size,
            100.0 * len(_REPEATED_MARKS.findall(text)) / n if sum(marks) else 0.0,
            100.0 * sum(map(text.count, ",;:\"'()-")) / size,
            100.0 * len(hidden) / n,
            math.log1p(len(hidden)),
            100.0 * mixed / n,
            math.log1p(len(words)),
            100.0 * learned / n,
            math.log1p(learned),
            math.log1p(sum(weights.values())),
            math.log1p(len(weights)),
        ]


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_features(
    docs: DataFrame, keep: list[str], text_col: str = "text", learned: Mapping[str, float] | None = None
) -> DataFrame:
    """``keep`` and one double column f0, f1, ... for each feature."""
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    slim = docs.select(*kept, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    first = slim.columns[:-1]
    names = [f"f{i}" for i in range(len(FEATURES))]
    shared = docs.sparkSession.sparkContext.broadcast(dict(learned or {}))  # at most LEARNED entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(learned=shared.value)
        for batch in batches:
            rows = [extractor.features(t) for t in batch.column(len(first)).to_pylist()]
            table = np.array(rows, np.float64).reshape(len(rows), len(names))
            columns = [pa.array(table[:, i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(first)], *columns], [*first, *names])

    schema = ", ".join(x for x in (kinds, *[f"{n} double" for n in names]) if x)
    out = slim.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *names)


def _with_keys(texts: DataFrame) -> DataFrame:
    """(doc_id, toxic, text, key): near copies mostly share the key, the smallest hash of three words in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column(2).to_pylist():
                words = words_of((text or "").lower())
                shingles = {b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))}
                keys.append(min(map(xxhash.xxh3_64_intdigest, shingles)) >> 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "key"])

    slim = texts.select("doc_id", "toxic", "text")
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, toxic double, text string, key bigint")


def entry_counts(texts: DataFrame) -> DataFrame:
    """(half, entry, a, b): toxic and clean texts of each half that hold the entry; equal keys count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for half, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                held = {e for w in set(words_of((text or "").lower())) for e in entries_of(w)}
                counts.update((half, toxic, e) for e in held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, _, _ in counts], pa.int32()),
                    pa.array([e for _, _, e in counts], pa.string()),
                    pa.array([n if t == 1.0 else 0 for (_, t, _), n in counts.items()], pa.int64()),
                    pa.array([n if t != 1.0 else 0 for (_, t, _), n in counts.items()], pa.int64()),
                ],
                ["half", "entry", "a", "b"],
            )

    once = texts.dropDuplicates(["key", "toxic"]).select("half", "toxic", "text")
    counts = once.mapInArrow(run, "half int, entry string, a bigint, b bigint")
    return counts.groupBy("half", "entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a > 0")


def learned_lexicon(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Log odds of the entries that stand in clearly more of the ``toxic`` texts than of the ``clean`` ones."""
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic + 1.0)) - F.log(b / (clean + 1.0))
    low = odds - CLEAR * F.sqrt(1.0 / a + 1.0 / b)
    sums = counts.groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    chosen = sums.where((F.col("a") >= LEAST_TEXTS) & (low > LEAST_ODDS)).select("entry", odds.alias("w"), low.alias("low"))
    return {r.entry: r.w for r in chosen.orderBy(F.desc("low"), "entry").limit(LEARNED).collect()}


def _vectors(df: DataFrame) -> DataFrame:
    names = [f"f{i}" for i in range(len(FEATURES))]
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(df).drop(*names)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, toxic) of labelled ids that are not held out; by hash about ``rows`` of them where there are more."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("toxic"))
    )
    count = known.count()
    if count > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * rows / count))
    return known


class Model:
    """Boosted trees, the curve over their probability and the learned lexicon; without trees a constant."""

    def __init__(
        self,
        trees: GBTClassificationModel | None,
        curve: IsotonicRegressionModel | None,
        share: float,
        learned: Mapping[str, float] | None = None,
    ) -> None:
        self.trees, self.curve, self.share, self.learned = trees, curve, share, learned or {}

    def score(self, features: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and the score of rows with columns f0, f1, ..."""
        if self.trees is None:
            return features.select(*keep, F.lit(self.share).alias("score"))
        margin = self.trees.transform(_vectors(features)).withColumn("_p", vector_to_array("probability")[1])
        if self.curve is None:
            return margin.select(*keep, F.col("_p").alias("score"))
        out = self.curve.transform(margin.select(*keep, "_p"))
        return out.select(*keep, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_score"))).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, params: Mapping | None = None) -> Model:
    """Trees on four fifths of the sample, the curve on the rest."""
    sample = stage(labelled_sample(docs, labels, rows), "toxic-sample")
    # The sample is bounded by ``rows`` (give or take the spread of a hash), so its ids may go to every task.
    given = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    half = (F.pmod(F.xxhash64("key"), F.lit(2))).cast("int")
    texts = stage(_with_keys(given).withColumn("half", half), "toxic-texts")
    once = texts.select("key", "toxic", "half").distinct()
    sizes = {(r.half, r.toxic): r.n for r in once.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    counts = stage(entry_counts(texts), "toxic-entries")

    def lexicon(halves: tuple[int, ...]) -> dict[str, float]:
        toxic, clean = (sum(sizes.get((h, t), 0) for h in halves) for t in (1.0, 0.0))
        return learned_lexicon(counts.where(F.col("half").isin(*halves)), toxic, clean)

    parts = [with_features(texts.where(F.col("half") == h), ["doc_id", "toxic", "key"], learned=lexicon((1 - h,))) for h in (0, 1)]
    points = stage(_vectors(parts[0].unionByName(parts[1])).repartition(4, "doc_id"), "toxic-features")
    learned = lexicon((0, 1))
    for_curve = F.pmod(F.xxhash64(F.lit("curve"), "key"), F.lit(HELD_FOR_CURVE)) == 0
    found = points.groupBy(for_curve.alias("curve")).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()
    total, toxic = sum(r.n for r in found), sum(r.toxic for r in found)
    if not 0 < toxic < total:
        return Model(None, None, toxic / total if total else 0.0)
    mixed = {r.curve: 0 < r.toxic < r.n for r in found}
    part = points.where(~for_curve) if mixed.get(False) and mixed.get(True) else points
    learner = GBTClassifier(featuresCol="features", labelCol="toxic", **{**PARAMS, **(params or {})})
    trees = learner.fit(part)
    if part is points:
        return Model(trees, None, toxic / total, learned)
    kept = trees.transform(points.where(for_curve)).select("toxic", vector_to_array("probability")[1].alias("_p"))
    curve = IsotonicRegression(featuresCol="_p", labelCol="toxic", predictionCol="_score").fit(kept)
    return Model(trees, curve, toxic / total, learned)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and score."""
    return model.score(with_features(docs, [id_col], text_col, model.learned), [id_col])


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on labelled rows that are not held out, then score every row."""
    scored = predict(docs, fit(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
