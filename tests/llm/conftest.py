import pytest

LONG = " ".join(f"w{i * i % 977} said, at place {i % 31}:" for i in range(20_000))
AWKWARD = [
    (None, "A text without an id, but with words enough to be looked at by everybody."),
    (1, None),
    (2, ""),
    (3, "   \n\t \n"),
    (4, "word"),
    (5, "two words"),
    (6, LONG),
    (7, "The same text stands here three times, and it has more than a few words. " * 4),
    (8, "The same text stands here three times, and it has more than a few words. " * 4),
    (8, "The same text stands here three times, and it has more than a few words. " * 4),
    (8, "Another text has the id of those before, which ids are not meant to have."),
    (9, "é" * 300 + " ñandú — 日本語 🙂 12345 #$%"),
    (10, "x" * 1000),
    (11, "\x00\x1f\x85\xa0  odd blanks\r\n\r\nand\x0bsigns"),
    (12, "Café: api_key = 'abcDEF123456' and AKIA" + "Z9" * 9 + " or " + "0f" * 13 + ", all rights reserved; CC-BY."),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names the operators use too."""
    extra = ("id", "x", "s", "key", "rid", "label", "spans", "words", "bucket", "place", "score", "first", "region")
    rows = [(i, t, ("en" if k % 2 else "fr") if k % 3 else None, *["other"] * len(extra)) for k, (i, t) in enumerate(AWKWARD)]
    schema = "doc_id bigint, text string, lang string, " + ", ".join(f"`{x}` string" for x in extra)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def everything(awkward, documents):
    """The small table together with the awkward rows."""
    return documents.select("doc_id", "text", "lang").unionByName(
        awkward.selectExpr("doc_id + 1000000 as doc_id", "text", "lang")
    ).repartition(5)


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from offerwise.llm.common import prepare

    prepare(spark)


def texts_of(df):
    return [(r[0], r[1] or "") for r in df.select("doc_id", "text").collect()]
