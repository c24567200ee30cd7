"""Collocations against a plain count of all phrases."""

import re
from collections import Counter, defaultdict

import pytest
from offerwise.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string"


def plain(rows, least, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        wanted = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in wanted.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        found = []
        for p, a in wanted.items():
            if 100 * inside[p] >= 80 * a and inside[p]:
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(df, **settings):
    return sorted(tuple(r) for r in collocations.collocations(df, **settings).collect())


@pytest.mark.parametrize("group", [4_000_000, 400, 40, 3])
def test_every_partition_matches_brute_force(spark, documents, group, monkeypatch):
    monkeypatch.setattr(collocations, "TABLE", 10**9)
    df = documents.limit(40).select("doc_id", "text", "lang").cache()
    rows = [(r.text, r.lang) for r in df.collect()]
    assert got(df, least=4, group=group) == plain(rows, 4)


def test_whole_table_matches_brute_force(spark, documents, everything):
    for df in (documents, everything):
        rows = [(r.text, r.lang) for r in df.collect()]
        want = plain(rows, 30)
        assert want and got(df) == want


def test_awkward_rows(spark, awkward):
    rows = [(r.text, r.lang) for r in awkward.collect()]
    want = plain(rows, 5)
    assert {r[0] for r in want} >= {"und"} and got(awkward, least=5) == want
    assert got(awkward, least=5, top=3, group=50) == plain(rows, 5, 3)


def test_prefixes_are_continued_to_the_last_word(spark):
    """One phrase of four words in nearly every place: prefixes of one to three words all exceed the group."""
    df = spark.createDataFrame([(i, "a b c d. " * 50 + f"a b c e{i % 3}, a b f, a x", "en") for i in range(30)], SCHEMA)
    slim = collocations._slim(df, "text", "lang")
    parts, counted = collocations.partition(slim, collocations.word_counts(slim), 100)
    assert [k for k, g in parts.table.items() if g == collocations.Partition.SPLIT and k[1].startswith(b"a")] == [
        ("en", b"a"), ("en", b"a b"), ("en", b"a b c")
    ]
    assert ("en", "a b", 1560) in counted and ("en", "a b c", 1530) in counted
    assert got(df, group=100) == plain([(r.text, r.lang) for r in df.collect()], 30)


def test_groups_keep_to_the_budget(spark, documents):
    slim = collocations._slim(documents, "text", "lang")
    words = collocations.word_counts(slim).cache()
    parts, _ = collocations.partition(slim, words, 20_000)
    sizes = Counter()
    for r in words.collect():
        group = parts.group(r.lang, r.phrase.encode())
        if group != collocations.Partition.SPLIT:
            sizes[group] += r.f
    assert len(sizes) > 3 and max(sizes.values()) <= 1.5 * 20_000


def test_numbers_beyond_64_bits(spark):
    big = 5 * 10**17
    df = spark.createDataFrame([("en", "x y", big), ("en", "x", big + 3), ("en", "y", 2 * big)], "lang string, phrase string, f bigint")
    row = collocations.scored(df).first()
    assert row.score == 2000000 * big // (3 * big + 3)


def test_blocks_round_trip():
    words, rows = collocations.suffixes([b"One two, three four five six.", b"seven eight"])
    packed = collocations._pack(words, rows, rows[:, 0])
    back, local, counts = collocations._unpack(packed, 4)
    names = [b"", *back]
    assert [[names[i] for i in r] for r in local] == [[words[i] if i else b"" for i in r] for r in rows]
    assert counts.tolist() == rows[:, 0].tolist()


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "", "en"), (3, " .,\n", None)], [(1, "one word only", "en")]])
def test_nothing_to_find(spark, rows):
    assert got(spark.createDataFrame(rows, SCHEMA)) == []
