"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a test that rejects a document. On a sample every rule's time and rejection share are
measured; the rules are then ordered by rejection per cost and evaluated in one ``CASE WHEN``, which
stops at the first rule that rejects. The order changes the work, never the verdict.

Defined results: a null text is an empty text, has no words and is rejected; texts are read whole;
repeated rows give one row each; an empty table gives no rows and an arbitrary order of rules; only
the two named columns are read.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.sources.staging import stage

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Rows, about, that costs and rejection shares are estimated on.
SAMPLE_ROWS = 2000

MIN_WORDS = 50
MAX_REPEATED = 0.5
MIN_WORD_CHARS, MAX_WORD_CHARS = 1.5, 20.0
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINES = 0.5
MAX_UPPER = 0.6
MAX_DIGITS = 0.5


def _without(text: Column, signs: str) -> Column:
    return F.length(F.translate(text, signs, ""))


def _windows(words: Column) -> Column:
    """A 64-bit hash of each three consecutive words."""
    one = lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), one)


def _covered(keys: Column, mask: Column) -> Column:
    """Words inside windows that occur twice or more; ``keys`` are sorted, hash bits above position bits."""
    high = lambda x: x.bitwiseAND(F.bitwise_not(mask))
    same = lambda x, j: F.coalesce(
        (high(x) == high(F.get(keys, j + 1))) | (high(x) == high(F.get(keys, j - 1))),
        (high(x) == high(F.get(keys, j + 1))),
        (high(x) == high(F.get(keys, j - 1))),
        F.lit(False),
    )
    places = F.sort_array(F.transform(F.filter(keys, same), lambda x: x.bitwiseAND(mask)))
    start = F.struct(F.lit(-1).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda acc, p: F.struct(
            (p + 2).alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), p + 2 - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of every whole text beside ``text``; each step is one projection, all in the JVM."""
    c = F.col
    df = docs.select(c(id_col).alias("doc_id"), F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"))
    df = df.select(
        "*",
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.translate(line, BLANKS, "") != "").alias("lines"),
    )
    df = df.select("*", _windows(c("words")).alias("windows"))
    df = df.select(
        "*",
        # Position bits: as many as the number of windows needs.
        (F.expr("shiftleft(1L, cast(ceil(log2(size(windows) + 2)) as int))") - 1).alias("mask"),
        (F.size(F.array_distinct("windows")) < F.size("windows")).alias("repeats"),
    )
    df = df.select(
        "*",
        F.when(
            c("repeats"),
            F.sort_array(
                F.transform(
                    "windows", lambda h, i: h.bitwiseAND(F.bitwise_not(c("mask"))).bitwiseOR(i.cast("long"))
                )
            ),
        ).alias("keys"),
    )
    return df.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        _without(c("text"), BLANKS).cast("long").alias("word_chars"),
        (F.length("text") - _without(c("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(c("repeats"), _covered(c("keys"), c("mask"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(int(100 * MAX_REPEATED)) * F.col("n_words")
    )


def rules() -> dict[str, Column]:
    """The method's own rules over :func:`measure`'s columns; true rejects. Shares are of word characters."""
    c = F.col
    upper = F.length("text") - _without(c("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    digits = F.length("text") - _without(c("text"), "0123456789")
    return {
        "word_length": (c("word_chars") < MIN_WORD_CHARS * c("n_words"))
        | (c("word_chars") > MAX_WORD_CHARS * c("n_words")),
        "symbols": c("n_symbols") > MAX_SYMBOLS_PER_WORD * c("n_words"),
        "dup_lines": c("n_dup_lines") > MAX_DUP_LINES * c("n_lines"),
        "upper": upper > MAX_UPPER * c("word_chars"),
        "digits": digits > MAX_DIGITS * c("word_chars"),
    }


def estimate(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """(seconds, rejection share) of each rule on a sample of about ``sample_rows`` rows."""
    rows = docs.count()
    if not rows:
        return {name: (1.0, 0.0) for name in rules()}
    sample = stage(measure(docs.sample(min(1.0, sample_rows / rows), seed=7)), "quality-sample")
    out = {}
    for name, rule in rules().items():
        began = time.perf_counter()
        share = sample.agg(F.avg(rule.cast("double"))).first()[0]
        out[name] = (time.perf_counter() - began, share or 0.0)
    return out


def cascade(estimates: dict[str, tuple[float, float]]) -> Column:
    """True where no rule rejects; rules with the highest rejection per cost come first."""
    order = sorted(estimates, key=lambda name: (-estimates[name][1] / max(estimates[name][0], 1e-6), name))
    tests = rules()
    out = F.when(base_failed(), F.lit(False))
    for name in order:
        out = out.when(tests[name], F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its statistics, the base verdict and the cascade's verdict."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return measure(slim).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        cascade(estimate(slim)).alias("kept"),
    )


SQL = f"""
with w as (
  select doc_id, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g') <> '') as lines
  from documents),
grams as (
  select doc_id, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)),
twice as (select doc_id, i from grams qualify count(*) over (partition by doc_id, a, b, c) > 1),
covered as (
  select doc_id, count(*) as n from (
    select doc_id, i from twice union select doc_id, i + 1 from twice union select doc_id, i + 2 from twice)
  group by doc_id),
s as (
  select w.doc_id, cast(len(words) as bigint) as n_words,
         cast(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         len(lines) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         coalesce(n, 0) as n_repeat_words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_upper,
         length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) as n_digits
  from w left join covered using (doc_id)),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {int(100 * MAX_REPEATED)} * n_words as base_failed from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or word_chars < {MIN_WORD_CHARS} * n_words or word_chars > {MAX_WORD_CHARS} * n_words
            or n_symbols > {MAX_SYMBOLS_PER_WORD} * n_words or n_dup_lines > {MAX_DUP_LINES} * n_lines
            or n_upper > {MAX_UPPER} * word_chars or n_digits > {MAX_DIGITS} * word_chars) as kept
from b
"""
