"""Candidates, their starts and the masking of secrets against plain Python over whole texts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from almanac.llm import secret_scan

from .conftest import SMALL

HIDDEN = ["Tr0ub4d&r3", "aB3$kL9!mN2@pQ7#zX", "abcDEFghiJKLmnoPQRstu", "hunter2x", "p@ss,w0rd!?", "zQ%9 &xv ß§T", "Xy9-Zq_77.aa"]
LINES = ['password = "{}"', 'api_key: "{}"', "Authorization: Bearer {}", "pwd={}", "my_secret => '{}'", 'the token is "{}" now', "client-secret:=`{}`"]


def spans(docs, **more):
    return secret_scan.findings(docs, **more).collect()


def test_values_of_any_characters_are_candidates_and_masked(spark):
    rows, want, pick = [], {}, random.Random(9)
    for line in LINES:
        for value in HIDDEN:
            value = "".join(pick.choices("bcdfgQRSTZ", k=4)) + value  # a value in many texts would be a word
            if '"' in line or "'" in line or "`" in line or " " not in value and value[-1] not in "?!":
                text = f"Some words here. {line.format(value)}\nand more words after it."
                want[len(rows)] = (text.index(value), value)
                rows.append((len(rows), text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.start, r.value) for r in spans(docs)}
    assert got == want
    out = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    for i, text in rows:
        assert want[i][1] not in out[i] and out[i] == text.replace(want[i][1], secret_scan.MASK)


def test_words_of_the_dictionary_are_left(spark):
    words = "notice required without further warning because nothing matters today".split()
    rows = [(i, " ".join(random.Random(i).sample(words, 7))) for i in range(40)]
    rows += [(100, "The password: required for all."), (101, "token = notice"), (102, 'a secret is "without warning" today'), (103, 'password = "zQ8&xT2!"')]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert [i for i, text in rows if out[i] != text] == [103]


def test_shapes_away_from_names(spark):
    texts = ["mail joe.smith123@example.com now", "see https://a.example.org/p/12345678901234 there", "id 0123456789abcdef0123 end", "nothing-but-letters-here",
             "key=abcdefghijklmnop", "v 1.2.3", "xxxxxxxxxxxxxxxxxxxxxxxx", "x: 'abcdefghijkl'", "QUJDREVGR0hJSktMTU5PUA=="]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in spans(docs):
        assert texts[r.doc_id][r.start : r.start + r.n_chars] == r.value
        got.setdefault(r.doc_id, []).append(r.value)
    assert got == {0: ["joe.smith123"], 1: ["//a.example.org/p/12345678901234"], 2: ["0123456789abcdef0123"], 4: ["abcdefghijklmnop"],
                   7: ["abcdefghijkl"], 8: ["QUJDREVGR0hJSktMTU5PUA=="]}


def test_starts_and_numbers_of_all_candidates(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = spans(docs)
    assert len(rows) > 10
    by_doc = {}
    for r in rows:
        assert texts[r.doc_id][r.start : r.start + r.n_chars] == r.value
        by_doc.setdefault(r.doc_id, []).append((r.at, r.start))
    for own in by_doc.values():
        own.sort()
        assert [at for at, _ in own] == list(range(len(own))) and [s for _, s in own] == sorted({s for _, s in own})


def test_masking_changes_accepted_values_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = dict(texts)
    for r in sorted(spans(docs), key=lambda r: -r.start):
        if r.accepted:
            want[r.doc_id] = want[r.doc_id][: r.start] + secret_scan.MASK + want[r.doc_id][r.start + r.n_chars :]
    out = secret_scan.redacted(docs).collect()
    assert {r.doc_id: r.text for r in out} == want and want != texts
    assert all(r.n_chars == len(r.text) for r in out if r.text != texts[r.doc_id])


def test_many_candidates_in_one_text_take_linear_time(spark):
    one = " ".join(f"tok{i:09d}x" for i in range(100_000))
    named = "\n".join(f'password = "zQ8&xT{i}!"' for i in range(20_000))
    docs = spark.createDataFrame([(1, one), (2, named), (3, "x" * 500_000), (4, "a=" * 200_000), (5, "password " * 50_000), (6, "'" * 100_000)],
                                 "doc_id long, text string")
    start = time.perf_counter()
    got = secret_scan.findings(docs).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("start").alias("last")).collect()
    counts = {r.doc_id: (r.n, r.last) for r in got}
    assert counts[1] == (100_000, one.rindex("tok")) and counts[2] == (20_000, named.rindex("zQ8"))
    out = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert out[2].count(secret_scan.MASK) == 20_000 and "zQ8" not in out[2]
    assert time.perf_counter() - start < 60


def test_clashing_names_and_odd_rows(spark, odd):
    clash = odd.withColumns({c: F.lit("k") for c in ("_hash", "_id", "_of", "_text", "_row", "_cuts", "_new", "at", "_doc", "cut")})
    out = secret_scan.redacted(clash)
    assert out.schema == clash.schema and out.count() == clash.count()
    assert secret_scan.MASK in out.where("doc_id = 12").first().text


@pytest.mark.parametrize("kinds", [[], [1], [0, 1]])
def test_given_labels(spark, kinds):
    docs = spark.createDataFrame([(1, "k abc123456789 and def987654321zz")], "doc_id long, text string")
    features = secret_scan.candidates(docs).select("value", *secret_scan.FEATURES).collect()
    rows = [(*f, float(k)) for f in features for k in kinds]
    schema = "value string, " + ", ".join(f"{c} double" for c in secret_scan.FEATURES) + ", label double"
    found = spans(docs, labelled=spark.createDataFrame(rows, schema))
    assert len(found) == 2 and all(0 <= r.probability <= 1 for r in found)
