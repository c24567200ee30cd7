"""Toxicity: features by hand, accuracy on rows held out, odd tables."""

import pytest
from offerwise.llm import toxicity
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string"


def features(text):
    return dict(zip(toxicity.FEATURES, toxicity.Extractor().features(text)))


def test_features_by_hand():
    f = features("You are a loser and a clown. The weather is fine, and nobody else is named.")
    assert f["insult_rate"] == pytest.approx(100 * 2 / 16) and f["contempt_rate"] == 0 and f["kinds"] == 1
    assert f["near_share"] == 0.5  # "clown" is six words from "you"
    assert f["address_rate"] == pytest.approx(100 / 16)
    assert f["obfuscated_rate"] == 0 and f["mixed_words"] == 0
    assert features("") == dict.fromkeys(toxicity.FEATURES, 0.0)


@pytest.mark.parametrize("text", ["such an id1ot", "such an 1d!ot,", "a st*upid man", "a stuuuupid man", "a m o r o n here", "a l.o.s.e.r", "(tr@sh)"])
def test_disguised_words_are_found(text):
    assert features(text)["obfuscated_count"] > 0


@pytest.mark.parametrize("text", ["room 101 costs 50$", "we met at 7pm!", "a b c d", "x4@y.z", "hellooo there", "Idiotype", "wow!!! great"])
def test_plain_text_is_not_disguised(text):
    f = features(text)
    assert f["obfuscated_count"] == 0 and f["kinds"] == 0


def test_marks_and_capitals():
    f = features("STUPID!! Really? “Idiot”… yes")
    assert f["loud_abuse"] == 1 and f["repeated_marks"] == pytest.approx(25) and f["kinds"] == 2


def test_held_out_rows_are_scored_well(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").where("held_out")
    rows = out.select("toxic", "score", "predicted").collect()
    assert len(rows) > 1000  # some 10 of 1,300 labels are missed; a third of the abuse is in invented words
    right = sum(r.toxic == r.predicted for r in rows)
    assert right / len(rows) > 0.98
    caught = [r.predicted for r in rows if r.toxic == 1]
    assert sum(caught) / len(caught) > 0.9


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.toxicity_report(documents, x).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_awkward_rows(spark, awkward):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 0, 0), (2, 1, 1), (7, 0, 2)], "doc_id bigint, quality int, toxic int")
    known = labels.select("doc_id", "quality", F.col("toxic").cast("int").alias("toxic"))
    extra = known.unionByName(odd).withColumn("text", F.lit("x")).withColumn("f0", F.lit("x"))
    docs = awkward.withColumn("f0", F.lit(1)).withColumn("features", F.lit("x")).withColumn("toxic", F.lit(1))
    rows = toxicity.toxicity_report(docs, extra).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]


@pytest.mark.parametrize("given, score", [([], 0.0), ([(1, 1), (3, 1)], 1.0), ([(1, 0), (3, None)], 0.0)])
def test_labels_of_one_kind(spark, given, score):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], SCHEMA)
    labels = spark.createDataFrame([(i, t) for i, t in given for i in range(20)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.toxicity_report(docs, labels).collect()} == {score}


def test_no_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert toxicity.toxicity_report(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_sample_is_bounded(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "cast(id as string) as text")
    labels = spark.range(30_000).selectExpr("id as doc_id", "cast(id % 7 = 0 as int) as toxic")
    sample = toxicity.labelled_sample(docs, labels, rows=1000)
    assert 850 < sample.count() < 1150 and sample.where(toxicity.held_out()).count() == 0
