"""License scan by template-markup matching.

A template is wording with two kinds of markup: ``<<opt>> ... <</opt>>`` may be missing, and
``<<var:n>>`` stands for up to ``n`` words of any kind. Templates are compiled into token automata
whose mandatory words must match exactly; a text is licensed by a template where the automaton
accepts a run of its words. Beside the templates, three fixed phrases give the base labels.

Defined results: a null or empty text has no words, no labels, null word positions and score 0; texts
are read whole; repeated rows give one row each; only the two named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Words are runs of ASCII letters and digits (lower-cased) and of all non-ASCII characters; in UTF-8
# the latter are the bytes from 0x80 on.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MARK = re.compile(r"<<(opt)>>|<<(/opt)>>|<<var:(\d+)>>|([0-9a-z]+)")

TEMPLATES = {
    "mit": "<<opt>>released<</opt>> <<opt>>licensed<</opt>> under the <<opt>>terms of the<</opt>> mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files <<opt>>the software<</opt>> to deal in the software without restriction",
    "apache-2.0": "licensed under the apache license <<opt>>version<</opt>> 2 <<opt>>0<</opt>>",
    "gpl-grant": "you can redistribute it and or modify it under the terms of the gnu <<opt>>lesser<</opt>> "
    "<<opt>>affero<</opt>> general public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsd-named": "<<opt>>licensed<</opt>> under the <<opt>>terms of the<</opt>> bsd <<var:2>> license",
    "cc-by-4.0": "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> <<opt>>creative commons<</opt>> "
    "<<opt>>attribution<</opt>> cc by <<opt>>sa<</opt>> <<opt>>nc<</opt>> 4 0",
    "copyright-notice": "copyright <<opt>>c<</opt>> <<var:6>> all rights reserved",
    "gpl-notice": "licensed under the <<opt>>terms of the<</opt>> <<opt>>gnu<</opt>> <<opt>>lesser<</opt>> "
    "general public license",
    "public-domain": "<<opt>>released<</opt>> into the public domain",
}

ANY = ""


class Automaton:
    """Nondeterministic token automaton; state i waits for ``steps[i]`` or skips along ``skips[i]``."""

    def __init__(self, template: str) -> None:
        self.words: list[str] = []
        self.skips: dict[int, list[int]] = {}
        open_at: list[int] = []
        for opt, close, var, word in MARK.findall(template):
            if opt:
                open_at.append(len(self.words))
            elif close:
                self.skips.setdefault(open_at.pop(), []).append(len(self.words))
            elif var:
                first = len(self.words)
                self.words += [ANY] * int(var)
                end = len(self.words)
                for i in range(first, end):
                    self.skips.setdefault(i, []).append(end)
            else:
                self.words.append(word)
        if open_at:
            raise ValueError(f"unclosed optional region: {template}")
        self.final = len(self.words)
        self.start = self._closed({0})
        self.first = {self.words[i].encode() for i in self.start if i < self.final}
        self.needed = self._mandatory()

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.skips.get(todo.pop(), ()):
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def _mandatory(self) -> bytes:
        """The longest word on every path: texts without it cannot be accepted."""
        skipped = {i for a, ends in self.skips.items() for b in ends for i in range(a, b)}
        words = [w for i, w in enumerate(self.words) if w and i not in skipped]
        return max(words, key=len).encode()

    def accepts(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run of words that starts at ``at``, or -1."""
        states, end = self.start, -1
        for i in range(at, len(words) + 1):
            if self.final in states:
                end = i
            if i == len(words):
                break
            word = words[i].decode("utf-8", "replace")
            moved = {s + 1 for s in states if s < self.final and self.words[s] in (ANY, word)}
            if not moved:
                break
            states = self._closed(moved)
        return end

    def places(self, words: list[bytes]) -> int:
        """Accepted places; each starts after the end of the one before."""
        n, at = 0, 0
        while at < len(words):
            end = self.accepts(words, at) if words[at] in self.first else -1
            n += end >= 0
            at = end if end > at else at + 1
        return n


AUTOMATA = {label: Automaton(text) for label, text in TEMPLATES.items()}


def license_of(text: str) -> tuple[int, int, int | None, int | None, list[str], list[str], float]:
    """(n_words, n_base, first_word, last_word, base labels, all labels, score) of one text.

    The score is 1 where a template is accepted, 0.5 where only base phrases stand, else 0.
    """
    words = WORD.findall(text.encode("utf-8", "replace").lower())
    if not words:
        return 0, 0, None, None, [], [], 0.0
    joined = b" " + b" ".join(words) + b" "
    starts, labels = [], []
    for phrase, label in PHRASES.items():
        sought, at = b" " + phrase.encode() + b" ", -1
        while (at := joined.find(sought, at + 1)) >= 0:
            starts.append(joined.count(b" ", 0, at))
            labels.append(label)
    more = [
        label
        for label, automaton in AUTOMATA.items()
        if b" " + automaton.needed + b" " in joined and automaton.places(words)
    ]
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        sorted(set(labels)),
        sorted(set(labels) | set(more)),
        1.0 if more else 0.5 if labels else 0.0,
    )


SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels array<string>, labels array<string>, score double"
)
_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64())


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", *(x.split()[0] for x in SCHEMA.split(", "))]
    for batch in batches:
        found = [license_of(text or "") for text in batch.column(1).to_pylist()]
        columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(_ARROW)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: word and phrase counts, label lists and a score."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_scan, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def license_report(docs: DataFrame) -> DataFrame:
    """The columns of the registered query: label lists as comma-joined text."""
    return scan_licenses(docs).withColumns(
        {name: F.array_join(name, ",") for name in ("base_labels", "labels")}
    )
