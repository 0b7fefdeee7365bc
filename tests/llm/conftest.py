"""Small documents with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import re

import pytest

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, score string, kept int, size int, start int, "
          "length string, value string, component_id int")


@pytest.fixture(scope="session")
def odd_rows():
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " seventeen", None, None), (4, None, "en", "b"),
        (5, "", "de", "b"), (6, " \t\n ", "de", None), (None, base, "en", "a"), (None, None, None, None), (7, "one two", "en", "c"),
        (8, "ONE TWO", "en", "c"), (9, "123 456 !!", "en", "c"), (10, "wörter süß straße " * 3000, "de", "d"),
        (11, "x" * 20_000, "en", "d"), (12, 'a key: token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" here', "en", "e"),
        (13, "say <|endoftext|> now don't stop é \x1c end", "en", "e"),
    ]
    return [(i, t, lang, s, len(t) if t else None, "x", "y", 1, 2, 3, "z", "v", 9) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def texts_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
