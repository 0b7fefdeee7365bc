"""Ranked search against a plain loop over all documents, and its graph against plain sums."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from almanac.llm import ranked_search

from .conftest import SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(documents, items, k=10):
    """(item, rank, doc, score) by a loop over every document for every item."""
    counted = [(d, Counter(split(t))) for d, t in documents if split(t)]
    every, total = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in items:
        scored = []
        for doc, tf in counted:
            m = 25 + 75 * sum(tf.values()) * every // total
            score = sum(math.floor(1000 * math.log((2 * every + 2) / (2 * held[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m))
                        for w in split(text) if tf[w])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted(map(tuple, ranked_search.search(docs, items, **options).collect()), key=str)


def test_small_tables(spark, small):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = ranked([(r.doc_id, r.text) for r in small.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(small, items) == want
    assert found(small, items, queries_per_block=3) == want  # several blocks


def test_odd_rows(spark, odd, odd_rows, none):
    asked = [(1, "one TWO three three"), (2, None), (3, " .!? "), (None, "wörter süß"), (4, "one TWO three three"), (4, "one TWO three three"),
             (5, "nowhere"), (6, "x" * 20_000), (7, "five six " * 3000)]
    items = spark.createDataFrame([(i, t, 0, "n") for i, t in asked], "item_id long, text string, score int, name string")
    want = ranked([(r[0], r[1]) for r in odd_rows], asked)
    assert found(odd, items) == want and len({r[0] for r in want}) == 5
    assert found(odd, items, k=2) == ranked([(r[0], r[1]) for r in odd_rows], asked, 2)
    assert found(none, items) == [] and found(odd, items.limit(0)) == []
    assert ranked_search.search(odd, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_many_copies_go_by_key(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(3000, 0, -1)] + [(-i, "others") for i in range(3000)], "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "words")], "item_id int, text string")
    got = ranked_search.search(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(1, 11)) and len({r.score for r in got}) == 1


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "alpha"), ("a", "alpha"), (None, "alpha"), ("é", "alpha"), ("c", "")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "Alpha")], "item_id string, text string")
    assert [r.doc_id for r in ranked_search.search(docs, items).orderBy("rank").collect()] == ["a", "b", "é", None]


@pytest.mark.parametrize("seed", range(4))
def test_graph_sums_every_query_and_shares(seed):
    pick = random.Random(seed)
    common = [pick.sample(range(40), 12) for _ in range(3)]
    queries = [[*pick.choice(common), *pick.choices(range(60), k=pick.randrange(200))] for _ in range(30)] + [[], [5, 5, 5]]
    graph = ranked_search.mine(queries)
    value = [pick.randrange(1000) for _ in range(60)]
    node = [value[t] for t in graph.term_of]
    for a, b in zip(graph.left, graph.right, strict=True):
        node.append(node[a] + node[b])
    assert [sum(node[i] for i in p) for p in graph.parts] == [sum(value[t] for t in q) for q in queries]
    sums = len(graph.left) + sum(max(0, len(p) - 1) for p in graph.parts)
    assert sums < 0.8 * sum(max(0, len(q) - 1) for q in queries)
    pairs = Counter((a, b) for p in graph.parts for a in p for b in p if a < b)
    assert max(pairs.values(), default=0) <= 1 or max(len(q) for q in queries) > ranked_search.PIECE


def test_scores_of_a_block_do_not_depend_on_the_graph():
    queries, weights = [[0, 1, 2], [0, 1, 3], [1, 1]], np.array([5, 7, 11, 13])
    at, term, tf = np.array([0, 0, 1, 1]), np.array([0, 1, 1, 3]), np.array([1, 4, 2, 1])
    scorer = ranked_search.Scorer(ranked_search.mine(queries), weights, 2, 8)
    got = scorer.scores(np.array([5, 3]), at, term, tf)
    one = {(int(d), int(t)): int(weights[t]) * (10**9 * int(n) // (1000 * int(n) + 8 * (25 + 75 * [5, 3][d] * 2 // 8)))
           for d, t, n in zip(at, term, tf, strict=True)}
    assert got.tolist() == [[sum(one.get((d, t), 0) for t in q) for d in (0, 1)] for q in queries]
