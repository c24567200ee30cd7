"""Secret scan by assignment-aware lexing.

Three fixed patterns give the base spans. Around every ``:``, ``=`` and ``+=`` a lexer reads the name before
and the literal after the operator (quoted, triple-quoted, several joined by ``+`` or standing side by side,
or plain up to a blank or sign), and elements ``<name>text</name>`` as well. It keeps the literals in a table of
constants, follows names that stand for constants, defined before or after, and scores each literal by how
sensitive the name it reaches is. Literals that score high enough are added as spans of kind ``literal``;
the base spans always stay. The work is in proportion to the text: in a chain ``a=b=c`` a name ends at the
next operator, and after any other plain literal the search goes on behind it.

Defined results: a null text is an empty text and has no spans; texts are read whole; repeated rows
and repeated ids give one row each; only the two named columns are read, so other columns cannot
clash.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# The base patterns.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

OPERATOR = re.compile(r":=|=>|\+=|[:=]")
QUOTED = re.compile(r"""[ \t]*(?:\"{3}((?:(?!\"{3}).)*)\"{3}|'{3}((?:(?!'{3}).)*)'{3}|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)')""", re.S)
JOINED = re.compile(r"""[ \t]*(?:\+[ \t]*)?(?=["'])""")
PLAIN = re.compile(r"""[ \t]*([A-Za-z_][A-Za-z0-9_.-]*(?=[ \t]*\+?[:=])|[^\s"',;(){}\[\]]+)""")
ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.-]*)>([^<>\n]+)</\1>")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
NAME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
# Placeholders by their whole form (tags, variables, formats, masked values) or by a whole word in them.
PLACEHOLDER = re.compile(
    r"""(?x) \A(?: <[^<>]*> | \$\{[^{}]*\} | \$\([^()]*\) | \$[A-Z_][A-Z0-9_]* | \$[A-Za-z_]+ | %\(\w+\)[sdr]? | %\w+%
    | \w{0,4}\*{3,}\w{0,4} | (?i:null|none) )\Z
    | (?<![A-Za-z0-9]) (?i: change[-_.]?me[0-9]* | example | placeholder | dummy | redacted | x{4,}
    | your (?: (?:own|new|api|app|access|auth|client|secret|private|password|passwd|pass|pwd|token|key)+[0-9]* )? ) (?![A-Za-z0-9])"""
)

# How much each part of a name says that its value is secret.
NAME_WEIGHT = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6, "key": 0.5,
    "access": 0.4, "api": 0.4, "client": 0.2, "signing": 0.5, "encryption": 0.5, "bearer": 0.8,
}
SENSITIVE = 0.8
LEAST_SCORE = 0.7
LEAST_LENGTH = 8


def name_weight(name: str) -> float:
    """Sum of the weights of a name's parts, at most one; ``dbPassword`` and ``API-KEY`` split alike."""
    return min(1.0, sum(NAME_WEIGHT.get(part.lower(), 0.0) for part in NAME_PARTS.findall(name)))


def literal_weight(value: str) -> float:
    """0 for short, spaced or placeholder values, else entropy against four bits a character.

    A $, % or < inside a value, or a placeholder's word inside a longer run of letters, says nothing.
    """
    if len(value) < LEAST_LENGTH or any(c.isspace() for c in value) or PLACEHOLDER.search(value):
        return 0.0
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    return min(1.0, bits / 4.0) * (1.0 if mixed else 0.75)


def _name_before(text: str, at: int) -> str:
    """The identifier that ends at ``at``, past blanks, closing quotes and brackets on the same line."""
    while at > 0 and text[at - 1] in " \t":
        at -= 1
    while at > 0 and text[at - 1] in "\"']":
        at -= 1
    end = at
    while at > 0 and text[at - 1] in NAME_CHARS:
        at -= 1
    return text[at:end].strip(".-")


def _quoted(text: str, pos: int) -> tuple[str, int, int] | None:
    """Value, start and end of the quoted literals that begin at ``pos`` and are joined."""
    got = QUOTED.match(text, pos)
    if not got:
        return None
    parts, start, end = [got[got.lastindex]], got.start(got.lastindex), got.end(got.lastindex)
    while (more := JOINED.match(text, got.end())) and (got := QUOTED.match(text, more.end())):
        parts.append(got[got.lastindex])
        end = got.end(got.lastindex)
    return "".join(parts), start, end


def name_literal_pairs(text: str) -> Iterator[tuple[str, str, int, int, bool]]:
    """(name, value, start, end, quoted) for each operator that has a name before and a literal after it."""
    pos = 0
    while found := OPERATOR.search(text, pos):
        pos = found.end()
        if text[pos : pos + 1] == "=" or text[found.start() - 1 : found.start()] in ("!", "<", ">", "="):
            continue
        name = _name_before(text, found.start())
        if not name:
            continue
        if got := _quoted(text, pos):
            yield name, *got, True
        elif plain := PLAIN.match(text, pos):
            yield name, plain[1], plain.start(1), plain.end(1), False
            pos = max(pos, plain.end())
    if "</" in text:
        for found in ELEMENT.finditer(text):
            yield found[1], found[2], found.start(2), found.end(2), True


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals whose own or propagated target name is sensitive."""
    constants: dict[str, tuple[str, int, int]] = {}
    targets: list[tuple[float, tuple[str, int, int], bool]] = []
    for name, value, start, end, quoted in name_literal_pairs(text):
        source, follows = (value, start, end), not quoted and bool(IDENTIFIER.match(value))
        if follows and value in constants:
            source, follows = constants[value], False
        constants[name] = source
        weight = name_weight(name)
        if weight >= SENSITIVE:
            targets.append((weight, source, follows))
    out: dict[tuple[int, int], float] = {}
    for weight, source, follows in targets:
        if follows:
            source = constants.get(source[0], source)
        score = weight * literal_weight(source[0])
        if score >= LEAST_SCORE:
            out[source[1:]] = score
    return list(out)


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text by start, then kind; offsets are code points, the end is exclusive."""
    spans: list[tuple[int, int, int]] = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if ":" in text or "=" in text or "</" in text:
        base = sorted((s, e) for s, _, e in spans)
        starts = [s for s, _ in base]
        reach = list(accumulate((e for _, e in base), max))
        for s, e in literal_spans(text):
            before = bisect_right(starts, s)
            if not before or reach[before - 1] < e:
                spans.append((s, 3, e))
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        found = [
            [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(text or "")]
            for text in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], ["id", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``spans``, ordered by start and kind."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_scan, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a text replaced by ``mark``; overlapping spans are replaced together.

    A text without spans, and a null, stay as they are.
    """
    names = docs.columns
    at = names.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else _masked(t, mark) for t in batch.column(at).to_pylist()]
            columns = [batch.column(i) if i != at else pa.array(texts, pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(clean, docs.schema)


def _masked(text: str, mark: str) -> str:
    out, done = [], 0
    for _, start, end in find_spans(text):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return text if not out else "".join(out) + text[done:]


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and span digests per document: the columns of the registered query."""
    spans = scan_secrets(docs)
    text = lambda rows: F.array_join(
        F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["kind"] != "literal")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        count("literal").alias("n_literal"),
    )
