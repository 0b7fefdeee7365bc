"""Near-duplicates against all pairs."""

import random

import pytest

from almanac.llm import near_dedup
from almanac.llm.graph import components

from .conftest import WORD, texts_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w.translate(LOWER) for w in WORD.findall(text or "")]
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def groups(texts):
    """Smallest id reachable, by all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def check(docs):
    rows = near_dedup.near_duplicates(docs).collect()
    want, sizes = groups({i: t for i, t in texts_of(docs).items() if i is not None})
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], sizes[r.doc_id], want[r.doc_id] == r.doc_id)


def test_small_documents(small):
    check(small)


def test_odd_documents(odd, none):
    check(odd)
    assert near_dedup.near_duplicates(none).count() == 0


def test_a_large_family_with_links_only_between_some(spark):
    """Copies of one text with more and more changed words: many share values, few are linked, chains occur."""
    pick = random.Random(5)
    base = [f"w{pick.randrange(400)}" for _ in range(120)]
    texts = {1000: " ".join(base)}
    for i in range(90):
        words = list(base)
        for _ in range(pick.choice([1, 2, 3, 4, 5, 6, 8])):
            words[pick.randrange(len(words))] = f"new{pick.randrange(10_000)}"
        texts[i] = " ".join(words)
    drifting = list(base)
    for i in range(2000, 2040):
        drifting[pick.randrange(len(drifting))] = f"drift{i}"
        texts[i] = " ".join(drifting)
    texts |= {3000 + i: " ".join(base) for i in range(30)}
    texts |= {4000 + i: " ".join(f"x{pick.randrange(500)}" for _ in range(80)) for i in range(60)}
    check(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))


def test_deduplicated_keeps_columns_and_one_of_each(odd, none):
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    want, _ = groups({i: t for i, t in texts_of(odd).items() if i is not None})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({v for v in want.values()})
    # texts are compared whatever their id: the copy of document 1 goes, the row without text stays
    assert [r.text for r in kept.where("doc_id IS NULL").collect()] == [None]
    assert near_dedup.deduplicated(none).count() == 0


def test_deduplicated_tells_rows_of_one_id_apart(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, one, "x"), (1, two, "x"), (1, two, "y"), (2, two + " more", "x"), (None, one + " end", "x"), (None, "c d e f g h i", "x"), (3, "", "x"), (3, "", "x"), (3, " \n", "x"),
            (4, None, "x"), (4, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = sorted(((r.doc_id, r.text) for r in near_dedup.deduplicated(docs).collect()), key=str)
    assert kept == sorted([(1, one), (1, two), (None, "c d e f g h i"), (3, ""), (3, ""), (3, " \n"), (4, None), (4, None)], key=str)


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(7, 3), (3, 9), (20, 21), (21, 22), (9, 1), (1, 1)]])
def test_components(spark, edges):
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
