"""Runs of words: the grammar's queries, the runs and the report against plain versions."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from offerwise.llm import runs


def plain_runs(words):
    """Every period by itself: maximal stretches of equal words q apart, the smallest period of each."""
    n, found = len(words), {}
    number = {}
    x = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
    for q in range(1, n // 4 + 1):
        same = x[q:] == x[:-q]
        if np.count_nonzero(same) < max(6, 4 * q) - q:
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        for i, j in edges.reshape(-1, 2).tolist():
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
    return sorted((s, size, q) for (s, size), q in found.items())


def plain_row(doc_id, text):
    words = [w for w in runs_split(text or "")]
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def runs_split(text):
    out, word = [], ""
    for c in text:
        if c == " " or "\t" <= c <= "\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def periodic(rng, n, letters):
    out = []
    while len(out) < n:
        root = [rng.choice(letters) for _ in range(rng.randint(1, 12))]
        out += (root * rng.randint(1, 9))[: rng.randint(1, 80)]
    return out[:n]


@pytest.mark.parametrize("seed", range(4))
def test_agreement_of_all_pairs(seed):
    rng = random.Random(seed)
    x = np.array([int(c) for c in periodic(rng, 150, ["1", "2", "3"][: 1 + seed % 3])] + [9])
    x = np.concatenate([[8], x])
    for enough in (1, 10):
        levels = runs.grammar(x, enough)
        i, j = (a.ravel() for a in np.triu_indices(len(x), 1))
        want = []
        for a, b in zip(i, j):
            n = 0
            while b + n < len(x) and x[a + n] == x[b + n]:
                n += 1
            want.append(n)
        assert runs.agreement(levels, i, j).tolist() == want
        mirror = [level.mirrored() for level in levels]
        back = runs.agreement(mirror, len(x) - 1 - j, len(x) - 1 - i)
        for a, b, n in zip(i, j, back):
            assert (x[a - n + 1 : a + 1] == x[b - n + 1 : b + 1]).all() and (a - n < 0 or x[a - n] != x[b - n])


def test_grammar_gives_the_text_back():
    x = np.array([7] + [1, 2, 1, 1, 1, 2, 3] * 30 + [8])
    levels = runs.grammar(x, 1)
    assert len(levels[-1].letters) <= 2
    for level, above in zip(levels, levels[1:]):
        assert len(above.letters) == len(level.first) and level.parent.max() == len(level.first) - 1
        for name in np.unique(above.letters):
            at = np.flatnonzero(above.letters == name)
            ends = np.append(level.first, len(level.letters))
            assert len({tuple(level.letters[ends[k] : ends[k + 1]]) for k in at}) == 1


@pytest.mark.parametrize("seed", range(30))
def test_runs_match_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(runs, "TOGETHER", rng.choice([50, 10**6]))
    monkeypatch.setattr(runs, "QUERIES", rng.choice([3, 10**6]))
    letters = [b"a", b"b", b"c", b"d", b"e"][: 1 + seed % 5]
    texts = [periodic(rng, rng.choice([0, 1, 5, 6, 7, 30, 200, 400]), letters) for _ in range(12)]
    assert runs.find_runs(texts) == [plain_runs(t) for t in texts]


def test_one_word_and_many_runs():
    texts = [[b"a"] * n for n in (5, 6, 4000)] + [[b"a", b"b"] * 3, [b"a", b"b"] * 4, [b"a", b"b", b"c"] * 4 + [b"a"]]
    assert runs.find_runs(texts) == [[], [(0, 6, 1)], [(0, 4000, 1)], [], [(0, 8, 2)], [(0, 13, 3)]]
    assert runs.collapsed([b"x"] + [b"a", b"b"] * 4 + [b"y"], [(1, 8, 2)]) == b"x a b y"


def test_report_matches_brute_force(spark, everything, awkward):
    for df in (everything, awkward):
        got = [tuple(r) for r in runs.run_report(df).collect()]
        want = [plain_row(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert Counter(got) == Counter(want)
        assert any(r[1] for r in want)


def test_some_texts_of_the_table_have_planted_runs(spark, documents):
    rows = runs.run_report(documents).collect()
    assert sum(r.n_runs > 0 for r in rows) > len(rows) // 20
    assert all((r.n_runs > 0) == (r.start is not None) for r in rows)


def test_report_of_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, runs int")
    assert runs.run_report(empty).collect() == []


def test_runs_themselves(spark):
    df = spark.createDataFrame([("k", "x a b a b a b a b y", "z")], "name string, body string, collapsed string")
    row = runs.collapse_runs(df, "name", "body").first()
    assert [tuple(r) for r in row.runs] == [(1, 8, 2)] and row.collapsed == "x a b y" and row.name == "k"
