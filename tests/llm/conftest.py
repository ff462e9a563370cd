"""Fixtures for the optional subpackage: awkward documents and whole tables on a small scale."""

import pytest
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        *(T.StructField(n, T.StringType()) for n in ("key", "ids", "score", "shard", "digest", "id", "root", "n", "x")),
    ]
)


def document(number, text, lang="en"):
    return (number, text, lang, "s", len(text or ""), *["clash"] * 9)


AWKWARD = [
    document(1, None, None),
    document(2, ""),
    document(3, " \t\n\x0b\x0c\r "),
    document(4, "It's the cat's <|endoftext|> don't  \n\n stop!!  "),
    document(5, "one two three four five six"),
    document(5, "one two three four five six"),  # a repeated row
    document(7, "one two  three four\tfive six"),  # equal without white space
    document(8, "ONE two three four five six"),  # equal as shingles
    document(9, "a" * 9000),
    document(10, "word " * 6000),
    document(11, "漢字かな交じり文 ünïcödé İstanbul Σίσυφος 👍🏽 ١٢٣ x²"),
    document(12, "123 456 !!! ..."),
    document(None, "a row without an id", None),
    document(14, "\x1c\x85 　 odd   spaces"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
