"""N-gram Jaccard join, repeated strings and the pipeline."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from offerwise.llm import jaccard, repeats
from pyspark.sql import functions as F


def brute_components(rows, words, percent):
    """Counter of (doc_id, set size, component) by an inverted index over all shingles."""
    sets = []
    for _, text in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    index, up = defaultdict(list), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        met = Counter(j for x in s for j in index[x])
        for j, n in met.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
        for x in s:
            index[x].append(i)
    first = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            first[find(i)] = min(first.get(find(i), doc), doc)
    return Counter((doc, len(sets[i]), first.get(find(i))) for i, (doc, _) in enumerate(rows))


def near_copies(spark, n):
    """A family of near copies at many distances, a chain, and unrelated texts that share one passage."""
    rng = np.random.default_rng(5)
    word = lambda: "w" + str(rng.integers(10**9))
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(40)]
    rows = []
    for i in range(n):
        copy = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 7)):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    chain = [word() for _ in range(100)]
    for i in range(n):
        chain = [*chain[3:], word(), word(), word()]
        rows.append((1000 + i, " ".join(chain)))
    for i in range(n):
        rows.append((2000 + i, " ".join([word() for _ in range(25)] + passage + [word() for _ in range(10)])))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("region,pivots,depth", [(1500, 16, 4), (6, 3, 2)])
def test_join_matches_brute_force(spark, everything, monkeypatch, region, pivots, depth):
    monkeypatch.setattr(jaccard, "REGION", region)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "DEPTH", depth)
    df = near_copies(spark, 40).unionByName(everything.selectExpr("doc_id + 5000 as doc_id", "text"))
    rows = [(r[0], r[1] or "") for r in df.collect()]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(df).collect())
    assert got == brute_components(rows, 4, 85)


def test_cells_cut_again_keep_links_of_documents_that_no_pivot_holds(spark, monkeypatch):
    """A region whose base is a pivot, copies that link with the base, and an edit of each that links with it alone."""
    monkeypatch.setattr(jaccard, "REGION", 10)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "DEPTH", 2)
    n = 30
    order = spark.range(1, 2 * n + 2).selectExpr("id", "xxhash64(id, 0) as x").orderBy("x").collect()
    rids = [r.id for r in order]  # the base comes first in the first cut
    base = set(range(200))
    copies = [base - set(range(i, i + 14)) | set(range(1000 * i + 1000, 1000 * i + 1014)) for i in range(n)]
    edits = [s - set(range(100 + i, 106 + i)) | set(range(1000 * i + 1500, 1000 * i + 1506)) for i, s in enumerate(copies)]
    rows = [(rid, len(s), sorted(s)) for rid, s in zip(rids, [base, *copies, *edits])]
    sets = spark.createDataFrame(rows, "rid bigint, n int, set array<bigint>")
    regions = sets.selectExpr(f"{rids[0]}L as region", "rid")
    for copy, edit in zip(copies, edits):
        assert 100 * len(copy & base) >= 85 * len(copy | base) and 100 * len(edit & base) < 85 * len(edit | base)
        assert [100 * len(edit & x) >= 85 * len(edit | x) for x in copies].count(True) >= 1
    got = {(r.node, r.label) for r in jaccard.components(jaccard._links(regions, sets, 85)).collect()}
    assert got == {(rid, 1) for rid in rids}


def test_a_region_compares_no_set_twice(monkeypatch):
    """Copies of one base at many distances: most lie near many pivots, and few of them are linked."""
    rng = np.random.default_rng(11)
    sets = []
    for i in range(150):
        at = rng.choice(200, rng.integers(8, 20), replace=False)
        sets.append(np.unique(np.concatenate([np.delete(np.arange(200), at), 1000 * (i + 1) + np.arange(len(at))])).astype(np.uint64))
    plain = [set(x.tolist()) for x in sets]
    calls, overlaps = Counter(), jaccard.Region.overlaps

    def counted(self, i):
        calls[i] += 1
        out = overlaps(self, i)
        assert out.tolist() == [len(plain[i] & x) for x in plain]
        return out

    monkeypatch.setattr(jaccard.Region, "overlaps", counted)
    got = jaccard.Union(len(sets))
    for a, b in jaccard.join_region(sets, [2] * len(sets), list(range(len(sets))), 85):
        assert got.join(a, b)
    want = jaccard.Union(len(sets))
    for i, x in enumerate(plain):
        for j, y in enumerate(plain[:i]):
            if 100 * len(x & y) >= 85 * len(x | y):
                want.join(i, j)
    tops = [got.find(i) for i in range(len(sets))]
    assert tops == [want.find(i) for i in range(len(sets))] and 1 < len(set(tops)) < 150
    assert max(calls.values()) == 1


def test_screening_drops_what_shares_too_little_and_keeps_all_links(spark):
    """One region: links, a text that has under half in common with others, and one that holds another but is too long."""
    rng = np.random.default_rng(3)
    word = lambda n: ["w" + str(x) for x in rng.integers(0, 10**9, n)]
    base = word(600)
    near = [base[:at] + word(8) + base[at + 8 :] for at in (50, 200, 400)]
    texts = [base, *near, base[:270] + word(330), base + word(500)]
    chain = word(500)
    for _ in range(8):
        chain = chain[30:] + word(30)
        texts.append(chain)
    docs = spark.createDataFrame([(i, i, " ".join(t)) for i, t in enumerate(texts)], "id bigint, x bigint, text string")
    docs = docs.select("id", "text", "x").coalesce(1)
    base = docs.mapInArrow(
        jaccard._base(4, 85), "id bigint, x bigint, n bigint, key binary, counted bigint, low array<bigint>"
    ).withColumnRenamed("id", "rid")
    regions = spark.range(len(texts)).selectExpr("7L as region", "id as rid")
    kept = {r.rid for r in jaccard._screened(regions, base, 85).collect()}
    sets = [set(jaccard.shingles(" ".join(t)).tolist()) for t in texts]
    linked = {i for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j and 100 * len(x & y) >= 85 * len(x | y)}
    assert linked >= {0, 1, 2, 3, 6, 7, 13} and kept >= linked and not kept & {4, 5}


def test_join_with_other_parameters_and_one_of_each(spark):
    df = near_copies(spark, 30)
    rows = [(r[0], r[1]) for r in df.collect()]
    want = brute_components(rows, 5, 80)
    kept = sorted(r.doc_id for r in jaccard.first_of_each(df, 5, 80).collect())
    assert kept == sorted({c for _, _, c in want})


def test_join_of_nothing(spark, awkward):
    assert jaccard.join(awkward.limit(0)).count() == 0
    rows = jaccard.join(awkward.where("text is null or trim(text) = ''")).collect()
    assert {(r.n_shingles, r.component_id == r.doc_id) for r in rows if r.doc_id in (1, 2)} == {(0, True)}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 99), (99, 98)], "a bigint, b bigint")
    got = {(r.node, r.label) for r in jaccard.components(links).collect()}
    assert got == {(i, 1) for i in range(1, 61)} | {(98, 98), (99, 98), (100, 98)}


def test_prefix_length_keeps_one_shared_shingle():
    for percent in (80, 85):
        for n in range(1, 300):
            least = (percent * n + 99) // 100
            assert jaccard.prefix_length(n, percent) == n - least + 1


def brute_repeats(rows):
    length = repeats.LENGTH
    count = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = Counter()
    for doc, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[(doc, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())] += 1
    return out


def mosaic(spark):
    """Texts that share passages at many places, runs of one byte, and repeats inside one text."""
    rng = np.random.default_rng(9)
    text = lambda n: "".join(rng.choice(list("abcdeé \n"), n))
    shared = [text(n) for n in (120, 199, 200, 201, 350, 900)]
    rows = []
    for i in range(60):
        parts = [text(int(rng.integers(0, 300)))]
        for j in rng.integers(0, len(shared), rng.integers(0, 4)):
            parts += [shared[j], text(int(rng.integers(0, 120)))]
        rows.append((i, "".join(parts)))
    rows += [(100, "x" * 700), (101, "y" * 200), (102, "y" * 201), (103, "ab" * 300 + shared[5][100:400] + "ab" * 200)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("large,sorted_bytes", [(10_000, 1_000_000), (3, 2_000)])
def test_repeats_match_brute_force(spark, everything, monkeypatch, large, sorted_bytes):
    monkeypatch.setattr(repeats, "LARGE", large)
    monkeypatch.setattr(repeats, "SORTED_BYTES", sorted_bytes)
    df = mosaic(spark).unionByName(everything.selectExpr("doc_id + 5000 as doc_id", "text")).repartition(4)
    rows = [(r[0], (r[1] or "").encode()) for r in df.collect()]
    assert Counter(tuple(r) for r in repeats.remove_repeats(df).collect()) == brute_repeats(rows)


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(2)
    for n, letters in ((0, 2), (1, 2), (500, 2), (2000, 4), (300, 1)):
        text = rng.integers(0, letters, n).astype(np.uint8)
        order = repeats.suffix_order(text)
        raw = text.tobytes()
        suffixes = [raw[i : i + repeats.LENGTH] for i in order]
        assert sorted(order.tolist()) == list(range(n)) and suffixes == sorted(suffixes)


def test_blocks_of_long_texts(monkeypatch):
    rng = np.random.default_rng(4)
    text = rng.integers(97, 123, 5000).astype(np.uint8).tobytes() * 2

    def windows(block):
        monkeypatch.setattr(repeats, "BLOCK", block)
        out = {}
        for data, parts in repeats._pieces([text]):
            first, last, grams = repeats.contexts(data, [p for _, p, _ in parts[1:]] + [len(data)])
            for a, b, g in zip(first.tolist(), last.tolist(), grams.tolist()):
                place, start = max((p, s) for _, p, s in parts if p <= a)
                for i in range(a, b + 1):
                    out[i - place + start] = g
        return out

    assert windows(10**6) == windows(700) and len(windows(700)) == len(text) - repeats.LENGTH + 1


def test_repeats_of_awkward_tables(spark, awkward):
    assert repeats.remove_repeats(awkward.limit(0)).count() == 0
    out = repeats.without_repeats(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert out.where("text is null").count() == awkward.where("text is null").count()


def test_pipeline_stages_match_brute_force(spark, tmp_path):
    """Every stage against a plain version of its decision, on its own input."""
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    extra = docs.where("doc_id < 5").selectExpr("doc_id + 900 as doc_id", "text", "lang", "source", "n_chars")
    nothing = spark.createDataFrame([(990, None, "en", "s", 0), (991, "12 34", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(extra).unionByName(nothing)
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        inputs[name + "_out"] = docs
    text = lambda key: {r.doc_id: r.text for r in inputs[key].collect()}
    assert set(text("language_id")) - set(text("language_id_out")) == {990, 991}
    rows = [(i, t) for i, t in text("near_duplicates").items()]
    assert set(text("near_duplicates_out")) == {c for _, _, c in brute_components(rows, 5, 80)}
    rows = [(i, t.encode()) for i, t in text("repeated_passages").items()]
    removed = {x[0]: x[2] for x in brute_repeats(rows)}
    for i, t in text("repeated_passages_out").items():
        before = text("repeated_passages")[i] if i in (0, 1) else None
        assert before is None or (before == t) == (removed[i] == 0)
    assert set(text("secret_scan")) == set(text("secret_scan_out"))
    from offerwise.llm import secrets

    assert not any(k in ("access", "hex") for t in text("secret_scan_out").values() for k, _, _ in secrets.find_spans(t or ""))
    assert {r.doc_id for r in docs.collect()} == set(text("packing"))


@pytest.mark.parametrize("rows", ["all", "none"])
def test_pipeline_of_awkward_rows(spark, awkward, tmp_path, rows):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns, and a table without rows."""
    import corpus_pipeline

    docs = awkward.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    docs = docs if rows == "all" else docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "language_id" and rows == "all":
            assert docs.where("lang is null").count() == 0
            letters = [r.text for r in awkward.collect() if any(c.isalpha() for c in r.text or "")]
            assert sorted(r.text for r in docs.collect()) == sorted(letters)
    assert (docs.count() > 0) == (rows == "all")


def test_pipeline_leaves_only_its_last_table(spark):
    import glob

    import corpus_pipeline
    from offerwise.sources.staging import run_folder

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    left = {path.split("pipeline-")[1].rsplit("-", 1)[0] for path in glob.glob(f"{run_folder(spark)}/pipeline-*")}
    assert left == {corpus_pipeline.STAGES[-1][0]}
