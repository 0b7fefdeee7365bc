"""Targets, permutations and what the mix takes."""

from collections import Counter

import numpy as np

from almanac.llm import mixing

from .conftest import WORD


def test_targets_stop_at_three_times_the_source():
    got = mixing.targets({"a": 10, "b": 1000, "c": 1000, None: 5})
    assert got["a"] == 30 and got[None] == 15
    assert abs(got["b"] / got["c"] - 2) < 1e-12 and abs(sum(got.values()) - 2015) < 1e-9
    assert mixing.targets({"a": 0, "b": 7}) == {"a": 0.0, "b": 7.0}
    assert mixing.targets({}) == {}


def test_permutations_are_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        for key in (0, 1, 12345):
            assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, 1).tolist() != mixing.permuted(np.arange(1000), 1000, 2).tolist()


def check(docs):
    rows = mixing.mix(docs).collect()
    given = docs.select("doc_id", "text", "source").collect()
    words = lambda t: len(WORD.findall(t or ""))
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((g.doc_id, words(g.text)) for g in given)
    sizes = Counter()
    for g in given:
        sizes[g.source] += words(g.text)
    aims = mixing.targets(dict(sizes))
    assert Counter((r.source_size, round(r.target, 6)) for r in rows) == Counter((sizes[g.source], round(aims[g.source], 6)) for g in given)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    return rows


def test_small_documents(small):
    rows = check(small)
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source_size, r.target] += r.taken
    for (size, target), words in taken.items():
        assert abs(words - target) <= 2 * mixing.BLOCK_WORDS, (size, target, words)


def test_odd_documents(odd, none):
    check(odd)
    assert mixing.mix(none).count() == 0


def test_mixed_documents_hold_the_words_taken(odd, small, none):
    for docs in (odd, small):
        taken = Counter()
        for r in mixing.mix(docs).collect():
            taken[r.doc_id] += r.taken
        mixed = mixing.mixed_documents(docs)
        assert mixed.columns == docs.columns
        whole = {r.doc_id: r.text for r in docs.collect()}
        got = Counter()
        for r in mixed.collect():
            got[r.doc_id] += len(WORD.findall(r.text))
            assert r.n_chars is None or len(r.text) == r.n_chars
            if r.doc_id is not None:
                assert all(w in whole[r.doc_id] for w in WORD.findall(r.text)[:50])
        assert +got == +taken
    assert mixing.mixed_documents(none).count() == 0


def test_draws_of_the_shards():
    sources = [mixing._source(n, size, target, 64, 3) for n, size, target in (("a", 64_000, 190_000.0), ("b", 640_000, 500_000.0), (None, 0, 0.0), ("c", 6_400, 19_200.0))]
    counts = mixing.shard_counts(sources, 64)
    assert counts.shape == (64, 4) and (counts >= 0).all() and len({tuple(row) for row in counts.tolist()}) > 50
    assert abs(counts.sum() - sum(s.slots for s in sources)) <= 1
    for own, s in zip(counts.sum(axis=0).tolist(), sources, strict=True):
        assert own <= 3 * s.blocks and abs(own - s.slots) <= 40
    assert (counts == mixing.shard_counts(sources, 64)).all() and (counts != mixing.shard_counts(sources, 64, seed=1)).any()
    assert mixing.shard_counts([], 64).sum() == 0


def test_taken_is_what_the_drawn_blocks_hold(small, odd, none):
    """The mix by a plain loop: blocks of each source's stream, slots of the shards, permutations by index."""
    for docs in (small, odd):
        made = mixing.plan_mix(docs)
        shards = max(64, -(-int(sum(s.slots for s in made.sources)) // mixing.SHARD_SLOTS))
        counts = mixing.shard_counts(made.sources, shards)
        times = Counter()
        for place, s in enumerate(made.sources):
            for slot in range(int(counts[:, place].sum())):
                key = mixing._key(s.name, slot // s.blocks, mixing.SEED)
                times[place, int(mixing.permuted(np.array([slot % s.blocks]), s.blocks, key)[0])] += 1
        want, streams = Counter(), Counter()
        for r in made.placed.collect():
            streams[r.place] += r.size
            taken = 0
            for word in range(r.start, r.start + r.size):
                taken += times[r.place, word // mixing.BLOCK_WORDS]
            want[r._id, r.size, taken] += 1
        assert Counter((r.doc_id, r.size, r.taken) for r in mixing.mix(docs).collect()) == want
        assert [streams[i] for i in range(len(made.sources))] == [s.size for s in made.sources]
        blocks = mixing.drawn_blocks(docs).collect()
        assert sum(r.words for r in blocks) == sum(size * 0 + taken * n for (_, size, taken), n in want.items())
        assert len({(r.source, r.slot) for r in blocks}) == sum(times.values()) and {r.shard for r in blocks} <= set(range(shards))
    assert mixing.drawn_blocks(none).count() == 0
