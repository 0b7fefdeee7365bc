"""Language, toxicity and quality: exactness against brute force, and accuracy on rows held out."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almanac.llm import language_id, quality_rules, toxicity
from almanac.llm.common import remainder
from almanac.llm.queries import QUERIES

from .conftest import WORD

MIDDLE = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op2_language_id"](spark, MIDDLE).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_scores_are_bayes():
    weights = np.log(np.random.default_rng(0).dirichlet(np.ones(language_id.BUCKETS + 1), 2)).astype(np.float32)
    counts = Counter()
    for at, bucket in language_id.grams(pa.array(["Ab, c", "", "ab c"])):
        counts.update(zip(at.tolist(), bucket.tolist(), strict=True))
    assert {b: n for (i, b), n in counts.items() if i == 0} == {b: n for (i, b), n in counts.items() if i == 2}
    assert sum(n for (i, _), n in counts.items() if i == 0) > 0 and not any(i == 1 for i, _ in counts)
    assert weights.shape == (2, language_id.BUCKETS + 1)


def plain_bayes(rows):
    """(predicted, probability) of each text by loops: counts of hashed n-grams, sums of logs."""
    def found(text):
        points = []
        for ch in text.lower() + "\n":
            if ch.isalpha():
                points.append(ord(ch))
            elif points and points[-1]:
                points.append(0)
        for n in (1, 2, 3):
            for i in range(len(points) - n + 1):
                if n == 1 and not points[i]:
                    continue
                mixed = sum((points[i + j] + 1) * language_id.PLACES[j] for j in range(n)) % 2**32
                yield ((mixed ^ (mixed >> 15)) * 2246822507 % 2**32 >> 16) % language_id.BUCKETS

    counts, docs = {}, Counter()
    for text, lang in rows:
        if lang is not None and text is not None:
            docs[lang] += 1
            counts.setdefault(lang, Counter()).update(found(text))
    logs = {}
    for lang, own in counts.items():
        whole = sum(own.values()) + language_id.SMOOTHING * language_id.BUCKETS
        logs[lang] = lambda b, own=own, whole=whole: np.log((own[b] + language_id.SMOOTHING) / whole)
    for text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            yield "und", 0.0
            continue
        scores = {lang: np.log(docs[lang] / sum(docs.values())) + sum(logs[lang](b) for b in found(text)) for lang in sorted(logs)}
        best = max(scores, key=scores.get)
        yield best, 1 / sum(np.exp(v - scores[best]) for v in scores.values())


def test_language_scores_by_brute_force(spark, odd):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 600").select("doc_id", "text", "lang").limit(60)
    rows = texts.unionByName(odd.where("doc_id < 10").select("doc_id", "text", "lang")).collect()
    docs = spark.createDataFrame([(i, r.text, r.lang) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, language_id.train(docs)).collect()}
    for i, (lang, score) in enumerate(plain_bayes([(r.text, r.lang) for r in rows])):
        assert got[i][0] == lang and abs(got[i][1] - score) < 0.01, (i, got[i], lang, score)


def test_rare_languages_are_learned(spark):
    rows = [(i, "the same words of a language", "aa") for i in range(3000)] + [(5000 + i, "ganz andere Wörter sind hier", "bb") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = language_id.row_counts(docs, F.lit(True))
    assert counts == {"aa": 3000, "bb": 3}
    sample = language_id.training_sample(docs, F.lit(True), counts, rows=100)
    kept = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert kept["bb"] == 3 and 50 < kept["aa"] < 200 and sample.columns == docs.columns
    langs, weights = language_id.train(sample, prior=counts)
    assert langs == ["aa", "bb"] and np.allclose(np.exp(weights[:, -1]), [3000 / 3003, 3 / 3003])


def test_language_of_odd_rows(odd, none):
    model = language_id.train(odd)
    rows = language_id.predict(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id in (4, 5, 6, 9):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in model[0]
    assert language_id.predict(none, model).count() == 0
    empty = language_id.train(none)
    assert empty[0] == [] and {r.lang_pred for r in language_id.predict(odd, empty).collect()} == {"und"}


def test_language_batches_do_not_change_scores(odd):
    model = language_id.train(odd)
    one = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in language_id.predict(odd, model).collect()}
    many = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in language_id.predict(odd.repartition(7), model).collect()}
    assert one == many


@pytest.fixture(scope="module")
def index(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.build_index(docs, labels, remainder("doc_id", 5) != 0)


def test_nearest_examples_are_exact(index):
    rng = np.random.default_rng(3)
    for _ in range(200):
        terms = np.sort(rng.choice(len(index.terms), rng.integers(1, min(8, len(index.terms)) + 1), replace=False))
        times = rng.integers(1, 5, len(terms))
        others = int(rng.integers(0, 500))
        query = np.append((1 + np.log(times)) * index.idf[terms], toxicity.OTHERS_WEIGHT * np.sqrt(others))
        cosines = (query / np.linalg.norm(query)) @ index.weights[np.append(terms, len(index.terms))]
        want = np.lexsort((np.arange(len(cosines)), -cosines))[: toxicity.NEIGHBOURS]
        want = want[cosines[want] > 0]
        found, got = index.nearest(terms, times, others)
        assert np.allclose(got, cosines[want])
        if not len(want):
            continue
        clear = cosines[found] > cosines[want].min() + 1e-9
        assert set(found[clear]) == set(want[cosines[want] > cosines[want].min() + 1e-9])


def test_toxicity_of_held_out_rows(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op5_toxicity_neighbours"](spark, MIDDLE).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) > 0.9 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_toxicity_of_odd_rows(spark, odd, none, index):
    rows = toxicity.score(odd, index).collect()
    assert len(rows) == odd.count() and {round(r.score, 9) for r in rows if r.doc_id in (4, 5, 6)} == {round(index.share, 9)}
    assert toxicity.score(none, index).count() == 0
    kept = toxicity.without_toxic(odd, index)
    assert kept.schema == odd.schema and kept.count() == sum(r.predicted == 0 for r in rows)
    nothing = toxicity.build_index(none, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert {r.score for r in toxicity.score(odd, nothing).collect()} == {0.0}
    alone = toxicity.build_index(odd, spark.createDataFrame([(1, 1), (1, None), (None, 1), (99, 0)], "doc_id long, toxic int"), F.lit(True))
    assert toxicity.score(odd, alone).count() == odd.count()


def statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = [False] * len(words)
    for i in range(len(words) - 2):
        if windows[words[i], words[i + 1], words[i + 2]] > 1:
            inside[i] = inside[i + 1] = inside[i + 2] = True
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(inside)


def test_quality_statistics(spark, odd, small, none):
    repeats = ["a a a a", "a b c a b c", "a b c d a b c", "x\nx\n\n \n x\nx", "é ü\tß\x0bö #|<>\r\n#|<>", "a b", "a a a", "p q r s p q r t q r s"]
    more = spark.createDataFrame(list(enumerate(repeats)), "doc_id long, text string")
    for docs in (odd, small, more):
        want = Counter((r.doc_id, *statistics(r.text)) for r in docs.select("doc_id", "text").collect())
        got = quality_rules.statistics(docs).select("doc_id", *quality_rules.BASE).collect()
        assert Counter(tuple(r) for r in got) == want
    assert quality_rules.statistics(none).count() == 0


def test_quality_rules_reject_bad_and_keep_good(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op10_quality_rules"](spark, MIDDLE).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.6 * len(bad)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert not any(r.kept for r in rows if r.base_failed)


def test_quality_of_odd_rows(spark, odd, none):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    rules = quality_rules.learn_rules(odd, no_labels)
    assert rules == [] and quality_rules.judge(odd, rules).count() == odd.count()
    assert quality_rules.judge(none, rules).count() == 0
    assert quality_rules.judge(odd, rules).where("kept AND base_failed").count() == 0


def test_learned_lists_separate_what_thresholds_can():
    rng = np.random.default_rng(2)
    values = {"a": rng.random(600), "b": rng.random(600)}
    bad = (values["a"] > 0.7) | (values["b"] < 0.1)
    rules = quality_rules.learn(values, bad, np.arange(600) % 3 == 0)
    held = np.zeros(600, bool)
    for rule in rules:
        held |= np.logical_and.reduce([c.holds(values) for c in rule])
    assert 1 <= len(rules) <= quality_rules.MAX_RULES and (held == bad).mean() > 0.95
    assert quality_rules.learn(values, np.zeros(600, bool), np.arange(600) % 3 == 0) == []


def test_index_holds_all_terms_and_texts_with_rare_words_are_searched(spark):
    """Too few examples for any test of significance: still, every term of theirs is in the index."""
    docs = spark.createDataFrame([(1, "vile fool"), (2, "calm lake walk"), (3, "a Fool sat"), (4, "lake"), (5, "unseen"), (6, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    index = toxicity.build_index(docs, labels, F.lit(True))
    assert index.terms.to_pylist() == ["calm", "fool", "lake", "vile", "walk"]
    assert np.allclose(index.idf, (np.log(6 / (1 + np.array([1, 2, 2, 1, 1]))) + 1) * np.sqrt(2))
    rows = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    assert [rows[i].evidence for i in range(1, 7)] == [["1"], ["2"], ["1"], ["2"], [], []]
    assert rows[3].score > 0.5 > rows[4].score and rows[5].score == rows[6].score == 0.5


def test_toxicity_recall_of_held_out_rows_by_language(spark):
    large = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{large}/labels.parquet").where("toxic IN (0, 1)").select("doc_id", "toxic")
    langs = spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op5_toxicity_neighbours"](spark, large).join(labels, "doc_id").join(langs, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    for lang in ("en", "de", "fr"):
        own = [r.predicted for r in toxic if r.lang == lang]
        assert len(own) >= 10 and sum(own) > 0.8 * len(own)
    assert sum(r.predicted for r in toxic) > 0.85 * len(toxic)
    assert sum(r.predicted for r in rows if r.toxic == 0) < 0.01 * sum(r.toxic == 0 for r in rows)
    assert all(r.evidence for r in rows if r.held_out and r.score != 0 and r.predicted)
