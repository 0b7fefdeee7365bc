"""Token counts and packing against the library, and the packing plan against its definition."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from almanac.llm import packing, token_counts
from almanac.llm.encoding import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_are_the_librarys(odd, small, library):
    for docs in (odd, small.select(*small.columns)):
        want = Counter((r.doc_id, len((r.text or "").encode()), len(ids(library, r.text))) for r in docs.select("doc_id", "text").collect())
        got = token_counts.count_tokens(docs, PATH).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_no_rows(none):
    assert token_counts.count_tokens(none, PATH).count() == 0
    assert packing.pack_documents(none, PATH).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_any_vocabulary(odd_rows, name):
    encoder = Encoder(public_tokenizers.path(name))
    texts = [row[1] or "" for row in odd_rows]
    ends, got = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert got[ends[i] : ends[i + 1]].tolist() == encoder.whole(text)
    assert encoder.count(pa.array(texts)).tolist() == np.diff(ends).tolist()


def test_forgetting_words_changes_nothing(odd_rows):
    texts = [row[1] or "" for row in odd_rows]
    few = Encoder(PATH, most_words=3)
    for text in texts * 2:
        assert few.encode(pa.array([text]))[1].tolist() == few.whole(text)


def test_the_table_has_lengths_and_spares_the_cache(small, odd_rows, library):
    table = token_counts.frequent_lengths(small, PATH)
    words = table.words.to_pylist()
    assert words and len(set(words)) == len(words) <= token_counts.TABLE_WORDS
    assert table.tokens.tolist() == [len(ids(library, word)) for word in words]
    encoder = Encoder(PATH)
    assert encoder.count(pa.array([" ".join(words[:500]), ""]), table).tolist() == [int(table.tokens[:500].sum()), 0]
    assert len(encoder.words) == 0, "words of the table are not encoded again"
    texts = [row[1] or "" for row in odd_rows] + [" ".join(words[::-7]) + " unheard-of0 " + "y" * 300]
    want = [len(ids(library, text)) for text in texts]
    for table in (table, token_counts.frequent_lengths(small, PATH, table_words=3), encoder.table([]), None):
        assert Encoder(PATH).count(pa.array(texts), table).tolist() == want
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not len(token_counts.frequent_lengths(small, other).words), "its tokens span white space"


def test_pieces_hold_each_id_once(odd, small, library):
    for docs in (odd, small):
        rows = packing.pack_documents(docs, PATH).collect()
        want = Counter()
        for r in docs.select("doc_id", "text").collect():
            own = [*ids(library, r.text), 2]
            for a, b in packing.cuts(len(own), 4096, 64):
                want[r.doc_id, a, b - a, zlib.crc32(np.array(own[a:b], "<u4").tobytes()), len(own)] += 1
        assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
        by = {}
        for r in rows:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for pieces in by.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 4096
    used = sum(length for pieces in by.values() for _, length in pieces)
    assert used > 0.99 * 4096 * (len(by) - 1)


def test_sequences_are_padded(small, library):
    packed = packing.pack_documents(small, PATH, with_ids=True)
    rows = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in rows.values():
        assert len(r.ids) == 4096 or len(r.ids) == r.n_tokens and r.n_tokens & (r.n_tokens - 1) == 0
    one = packed.where("start = 0").orderBy("doc_id").first()
    assert rows[one.sequence_id].ids[one.offset : one.offset + one.length] == one.ids


def test_cuts_cover_any_length():
    for n in (1, 63, 64, 65, 4095, 4096, 4097, 8192, 12345):
        parts = packing.cuts(n, 4096, 64)
        assert parts[0][0] == 0 and parts[-1][1] == n
        assert all(a < b <= a + 4096 for a, b in parts) and all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))


def test_combinations_are_all_partitions():
    rows = packing.combinations(8, 3)
    sums = {tuple(int(x) for x in row) for row in rows}
    want = {tuple(Counter(p)[i] for i in range(1, 8)) for p in
            ((a, b) for a in range(1, 8) for b in range(1, a + 1) if a + b == 8)} | {
        tuple(Counter(p)[i] for i in range(1, 8)) for p in
        ((a, b, c) for a in range(1, 8) for b in range(1, a + 1) for c in range(1, b + 1) if a + b + c == 8)}
    assert sums == want and len(rows) == len(want)


def test_least_squares_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        matrix, target = rng.integers(0, 4, (6, 15)).astype(float), rng.integers(0, 50, 6).astype(float)
        x = packing.least_squares(matrix, target)
        gain = matrix.T @ (target - matrix @ x)
        assert (x >= 0).all() and (gain <= 1e-5).all() and np.allclose(gain[x > 1e-9], 0, atol=1e-5)


def test_plan_places_every_number_once():
    rng = np.random.default_rng(1)
    histogram = Counter(int(x) for x in rng.integers(1, 4097, 500)) + Counter({640: 3000, 4096: 10})
    ranges = packing.plan(histogram)
    room = Counter()
    for length, first, past, sequence, repeats, _ in ranges:
        assert (past - first) % repeats == 0
        for repeat in range(repeats):
            room[sequence + repeat] += length * (past - first) // repeats
    assert max(room.values()) <= 4096
    for length, count in histogram.items():
        own = sorted((a, b) for n, a, b, *_ in ranges if n == length)
        assert own[0][0] == 0 and own[-1][1] == count and all(x[1] == y[0] for x, y in zip(own, own[1:], strict=False))
