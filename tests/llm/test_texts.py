"""Fingerprints, encoding, packing and language ID."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from offerwise.llm import bpe, fingerprints, langid, packing
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_sketches_recover_exact_differences():
    rng = np.random.default_rng(1)
    a = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 5, 300, 40, 7)]
    b = [a[0], a[1], rng.integers(0, 2**63, 9).astype(np.uint64), a[3][:290], np.concatenate([a[4], a[2]]), a[0]]
    only_a, only_b, rows = fingerprints.differences(a, b)
    for i, (x, y) in enumerate(zip(a, b)):
        x, y = set(x.tolist()), set(y.tolist())
        assert (only_a[i], only_b[i]) == (len(x - y), len(y - x))
        found = {int(k) for o, ks, _ in rows for o_, k in zip(o, ks) if o_ == i}
        assert found == x ^ y
    assert fingerprints.likeness(a[:2], b[:2]).tolist() == [1.0, 1.0]


def test_paragraphs_cover_the_text():
    text = "One. Two!  Three\nfour " + "word " * 200 + "end"
    assert "".join("".join(p.split()) for p in fingerprints.paragraphs(text)) == "".join(text.split())


def test_fingerprints_match_brute_force(spark, everything):
    df = everything.select("doc_id", "text")
    rows = sorted(((r[0], r[1] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        edit = text[: len(text) - n] + following[:n]
        sets = [set(fingerprints.digests(t).tolist()) for t in (text, edit, following)]
        near = [round(len(sets[0] & s) / len(sets[0] | s), 9) if sets[0] | s else 1.0 for s in sets[1:]]
        want.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), *near))
    out = fingerprints.compare_with_next(df).collect()
    got = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in out]
    assert Counter(got) == Counter(want)
    by_text = defaultdict(set)
    texts = Counter(rows)
    for r in out:
        for i, t in texts:
            if i == r.doc_id and texts[(i, t)] == 1 and sum(x == i for x, _ in texts) == 1:
                by_text[t].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_fingerprints_of_uneven_ids(spark):
    """Ids at both ends of 64 bits, an outlier, and repeated ids: right successors, and no range holds most rows."""
    ids = [-(2**63), 2**63 - 1, 2**62, *range(400), 7, 7]
    rows = [(i, f"Text {k} of many. It is like no other.") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    out = fingerprints.compare_with_next(df).withColumn("part", F.spark_partition_id()).collect()
    order = sorted(rows)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        n = len(text) // 4
        edited = hashlib.sha256((text[: len(text) - n] + following[:n]).encode()).hexdigest()
        assert any(r.doc_id == i and r.edited_sha256 == edited for r in out)
    assert len(out) == len(rows) and max(Counter(r.part for r in out).values()) < 0.7 * len(rows)


def test_paragraphs_without_blanks():
    text = "".join(map(chr, np.random.default_rng(3).integers(0x4E00, 0x6E00, 20_000).tolist()))
    parts = fingerprints.paragraphs(text)
    assert "".join(parts) == text and len(parts) > 200
    edited = fingerprints.digests(text[:9000] + "改" + text[9000:])
    assert len(set(fingerprints.digests(text).tolist()) ^ set(edited.tolist())) < 10
    assert fingerprints.paragraphs("第一句。第二句！") == ["第一句。", "第二句！"]


@pytest.mark.parametrize("size", [0, 1])
def test_fingerprints_of_very_small_tables(spark, size):
    df = spark.createDataFrame([(5, "Some words. And more words.")][:size], "doc_id bigint, text string")
    out = fingerprints.compare_with_next(df).collect()
    assert [(r.doc_id, r.near_next) for r in out] == [(5, 1.0)][:size]


def test_encoding_equals_the_library_and_decodes(everything):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = Counter()
    for r in everything.select("doc_id", "text").collect():
        text = r[1] or ""
        ids = enc.encode_ordinary(text)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want[(r[0], len(ids), digest, hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in bpe.encode(everything, RANKS, public_tokenizers.PATTERN).collect()) == want


def test_splitting_starts_anew_when_its_memory_is_full(monkeypatch):
    import pyarrow as pa

    ranks = bpe.read_ranks(RANKS)
    monkeypatch.setattr(bpe, "MEMORY", 50)
    rows = [(i, f"word{i} and {'x' * i} again") for i in range(60)]
    batches = [pa.RecordBatch.from_pydict({"id": [i], "text": [t]}) for i, t in rows]
    out = list(bpe._split(public_tokenizers.PATTERN, ranks)(iter(batches)))
    assert sum(b.column("fresh")[0].as_py() for b in out) > 1
    first = next(i for i, b in enumerate(out[1:], 1) if b.column("fresh")[0].as_py())
    assert out[first].column("codes")[0].as_py() == [0, 1, 2, 3]


def test_tokens_inside_a_word():
    ranks = bpe.read_ranks(RANKS)
    words = [b" the", b"x", b"", b"tionment", "é日".encode()]
    row, rank = bpe.Tokens(ranks).inside(words)
    got = set(zip(row.tolist(), rank.tolist()))
    want = {
        (k, ranks[w[i:j]]) for k, w in enumerate(words) for i in range(len(w)) for j in range(i + 2, len(w) + 1) if w[i:j] in ranks
    }
    assert got == want and list(zip(row, rank)) == sorted(zip(row, rank))


def test_vocabularies_that_merges_do_not_reach_are_refused():
    single = {bytes([i]): i for i in range(256)}
    assert bpe.merge_pairs({**single, b"ab": 256, b"abc": 257})[257] == (256, ord("c"))
    with pytest.raises(ValueError):
        bpe.merge_pairs({**single, b"abc": 256})


def test_long_words_merge_alike():
    import tiktoken

    ranks = bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for word in ("x" * 3000, "ab" * 700 + "c", "aaab" * 300, "the" * 400, "é" * 500):
        assert bpe.merge_long(word.encode(), ranks) == enc.encode_ordinary(word)


def test_packing_covers_every_token_once(spark, everything):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    one = everything.where("doc_id is not null").dropDuplicates(["doc_id"])
    df = spark.createDataFrame(one.select("doc_id", "text").collect(), "doc_id bigint, text string")
    docs = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in df.select("doc_id", "text").collect()}
    rows = packing.pack(df, WORDS).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = docs[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(docs[r.doc_id]) and zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    for i, ids in docs.items():
        assert _gapless(pieces[i]) == len(ids)
    sums = [_gapless(w) for w in windows.values()]
    assert max(sums) <= packing.CAPACITY and sum(sums) > 0.9 * packing.CAPACITY * len(sums)


def _gapless(parts):
    at = 0
    for start, length in sorted(parts):
        assert start == at and length > 0
        at += length
    return at


def test_packing_takes_awkward_rows(awkward, spark):
    out = packing.pack(awkward, WORDS)
    assert {r.doc_id for r in out.collect()} == {None, *range(1, 13)}
    assert packing.pack(awkward.limit(0), WORDS).count() == 0


def test_differencing_balances_and_windows_rise():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 513, 400).tolist()
    windows = packing.deal(sizes)
    assert sorted(i for w in windows for i in w) == list(range(400))
    assert max(sum(sizes[i] for i in w) for w in windows) <= packing.CAPACITY
    assert packing.deal([1500, 1500, 1500]) and len(packing.deal([1500, 1500, 1500])) == 3
    even = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(w[0] for w in even) == [14, 16]


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    texts = [
        "Émile's l'été — don't WE'LL  go_on 3rd! <|endoftext|> a<|startoftext|>b",
        "é ́x ﬁ İstanbul ẞ ß Σας ΣΑΣ ½ Ⅷ x² ÷×\x85y\xa0z w\x1cq",
        "a.b...c!!! $5.00 (x) [y] `z` \\ ~ ^ {| 日本語 🙂🙂",
        "",
    ]
    encoder = packing.encoder(WORDS)
    for text, ids in zip(texts, encoder.encode(texts)):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, text


def test_forward_sums_all_segmentations():
    table = {"a": (0.2,), "b": (0.3,), "ab": (0.1,), "ba": (0.05,), "aba": (0.01,)}

    def brute(word):
        if not word:
            return 1.0
        return sum(table[word[:i]][0] * brute(word[i:]) for i in range(1, len(word) + 1) if word[:i] in table)

    for word in ("a", "ab", "abab", "babaab"):
        assert langid.forward(word, table, 1)[-1][0] == pytest.approx(brute(word))
    counts = Counter()
    langid.expected("abab", 2.0, {k: v[0] for k, v in table.items()}, counts)
    assert sum(len(k) * v for k, v in counts.items()) == pytest.approx(8.0)


def test_joint_scores_equal_the_forward_algorithm():
    rng = np.random.default_rng(6)
    pieces = sorted({"▁", "a", "b", "ab", "ba", "▁a", "aba", "▁ab", "bbb"})
    table = rng.uniform(0.001, 0.2, (len(pieces), 3))
    model = langid.Model(["x", "y", "z"], pieces, table)
    words = ["a", "abab", "q", "aqb", "b" * 30, "abba" * 7, "▁a"]
    rows = {p: tuple(table[i]) for i, p in enumerate(pieces)}
    want = np.log([langid.forward("▁" + w, rows, 3)[-1] for w in words])
    assert np.allclose(model.log_probabilities(words), want)


def test_model_starts_anew_when_its_memory_is_full(monkeypatch):
    table = np.array([[0.5, 0.1], [0.1, 0.5], [0.1, 0.1]])
    texts = ["a a b", "b b", None, "12", "a b aa bb ab ba"]
    want = langid.Model(["x", "y"], ["a", "b", "▁"], table).predict(texts)
    monkeypatch.setattr(langid, "MEMORY", 3)
    model = langid.Model(["x", "y"], ["a", "b", "▁"], table)
    assert [model.predict([t])[0] for t in texts] == want == model.predict(texts)


def test_language_accuracy_on_held_out_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(df, PIECES).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang_pred == r.lang for r in out)
    assert len(out) > 150 and right / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_awkward_rows(awkward):
    rows = langid.identify(awkward, PIECES).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3}
    empty = langid.identify(awkward.where("lang is null"), PIECES).collect()
    assert {(r.lang_pred, r.score) for r in empty} == {("und", 0.0)}
    assert langid.identify(awkward.limit(0), PIECES).count() == 0
    model = langid.fit(awkward, PIECES)
    again = langid.with_prediction(awkward.withColumn("lang_pred", F.lit(1)), model)
    assert again.columns.count("lang_pred") == again.columns.count("score") == 1 and again.count() == awkward.count()


def test_language_sample_is_the_smallest_hashes_of_each_language(spark):
    rows = [(i, f"w{i}", "ab"[i % 3 == 0]) for i in range(600)] + [(4, "w4", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {(r.lang, r.word) for r in langid.sample_words(df, 20).collect()}
    hashed = df.where(~langid.held_out()).select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct().collect()
    assert got == {("a", "▁w"), ("b", "▁w")}
    counts = {r.lang: r.n for r in langid.sample_words(df, 20).collect()}
    first = {x: sorted((r.h, r.doc_id) for r in hashed if r.lang == x)[:20] for x in "ab"}
    copies = Counter((r[2], r[0]) for r in rows)
    assert counts == {x: sum(copies[(x, i)] for _, i in first[x]) for x in "ab"}
