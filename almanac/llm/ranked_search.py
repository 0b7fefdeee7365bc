"""Ranked lexical search of many queries at once, with what the queries share computed once.

A query is the multiset of its terms and a document's score is a sum over them, so queries that share
a set of terms share a partial sum. `mine` finds shared sets: the pair of terms that most queries
hold becomes a node of its own and takes the pair's place in them, nodes pair up with terms and with
other nodes in the same way, and this goes on until no pair is in two queries. The result is a graph
in which a node is the sum of two others and a query is the sum of a few nodes. Every task evaluates
it for a block of documents level by level: each node's accumulator (a score per document) is made
once, whatever the number of queries above it. A task keeps the best documents of each query; the best
of all tasks are ranked by one window per query.

Documents are read once per block of queries (QUERIES_PER_BLOCK distinct texts, by hash): their
term counts, restricted to the block's vocabulary, are staged in the shared folder. Counts of documents
and terms come from that table, over all rows. What is broadcast is a block's vocabulary and graph.

Terms are maximal runs of ASCII letters, digits and anything beyond ASCII, A to Z lower-cased. Null or
empty text has no terms, neither as a document, which then is not counted, nor as a query, which then has
no rows. Repeated documents are documents of their own; repeated query rows have the same rows each.
Equal scores go by ascending key, null keys last. Empty tables give no rows. Other columns are not
looked at. Scores are whole numbers, so no result depends on the order of sums.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices, text_or_empty
from almanac.sources.stage import stage

QUERIES_PER_BLOCK = 256
#: Terms of a query that are mined together; longer queries are cut into such pieces, frequent terms first.
PIECE = 64
#: Bytes of accumulators that a task holds, about.
ACCUMULATOR_BYTES = 24 << 20
#: Bytes of text whose terms are counted at once, about.
SLICE_BYTES = 1 << 20

#: Any byte that is no letter, digit or part of a character beyond ASCII becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Graph:
    """Node i < leaves is an occurrence of a term; node leaves + j is the sum of the nodes left[j] and right[j]."""

    term_of: tuple[int, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    parts: tuple[tuple[int, ...], ...]  # per query: the nodes it is the sum of

    @property
    def leaves(self) -> int:
        return len(self.term_of)

    def levels(self) -> list[np.ndarray]:
        """Inner nodes, those that depend on no other first."""
        height = [0] * self.leaves
        for a, b in zip(self.left, self.right, strict=True):
            height.append(1 + max(height[a], height[b]))
        own = np.array(height[self.leaves :], np.int64)
        return [np.flatnonzero(own == h) for h in range(1, own.max(initial=0) + 1)]


def mine(queries: Sequence[Sequence[int]]) -> Graph:
    """The graph of queries given as lists of term numbers, repeats included."""
    leaf: dict[tuple[int, int], int] = {}
    held = Counter(t for q in queries for t in set(q))
    pieces: list[set[int]] = []
    owner: list[int] = []
    for number, query in enumerate(queries):
        atoms = []
        for term, times in sorted(Counter(query).items(), key=lambda x: (-held[x[0]], x[0])):
            atoms += [leaf.setdefault((term, k), len(leaf)) for k in range(times)]  # the k-th occurrence
        for start in range(0, len(atoms), PIECE):
            pieces.append(set(atoms[start : start + PIECE]))
            owner.append(number)

    holders: dict[tuple[int, int], set[int]] = defaultdict(set)
    for at, piece in enumerate(pieces):
        ordered = sorted(piece)
        for i, a in enumerate(ordered):
            for b in ordered[i + 1 :]:
                holders[a, b].add(at)
    heap = [(-len(where), pair) for pair, where in holders.items() if len(where) > 1]
    heapq.heapify(heap)
    left, right = [], []
    while heap:
        count, pair = heapq.heappop(heap)
        where = holders[pair]
        if len(where) != -count:  # outdated
            if len(where) > 1:
                heapq.heappush(heap, (-len(where), pair))
            continue
        node = len(leaf) + len(left)
        left.append(pair[0])
        right.append(pair[1])
        fresh: set[tuple[int, int]] = set()
        for at in sorted(where):
            piece = pieces[at]
            piece -= {*pair}
            for other in piece:
                for old in pair:
                    holders[min(old, other), max(old, other)].discard(at)
                holders[other, node].add(at)
                fresh.add((other, node))
            piece.add(node)
        holders.pop(pair)
        for new in fresh:
            if len(holders[new]) > 1:
                heapq.heappush(heap, (-len(holders[new]), new))
    parts: list[list[int]] = [[] for _ in queries]
    for number, piece in zip(owner, pieces, strict=True):
        parts[number] += sorted(piece)
    return Graph(tuple(t for t, _ in leaf), tuple(left), tuple(right), tuple(map(tuple, parts)))


class Scorer:
    """Scores of blocks of documents for all queries of a graph."""

    def __init__(self, graph: Graph, weights: np.ndarray, documents: int, all_terms: int):
        self.graph, self.weights, self.documents, self.all_terms = graph, weights, documents, all_terms
        self.nodes = graph.leaves + len(graph.left)
        self.term_of = np.array(graph.term_of, np.int64)
        self.levels = [(graph.leaves + own, np.array(graph.left)[own], np.array(graph.right)[own]) for own in graph.levels()]
        self.with_parts = np.array([i for i, p in enumerate(graph.parts) if p], np.int64)
        self.flat = np.array([n for p in graph.parts for n in p], np.int64)
        self.starts = np.cumsum([0, *(len(p) for p in graph.parts if p)])[:-1]
        self.rows = max(16, ACCUMULATOR_BYTES // (8 * (self.nodes + len(self.flat) + 1)))  # documents in a block

    def scores(self, sizes: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Queries x documents; the document at[i] holds term[i] tf[i] times."""
        length = 25 + (75 * sizes * self.documents) // self.all_terms
        by_term = np.zeros((len(self.weights), len(sizes)), np.int64)
        by_term[term, at] = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[at]))
        node = np.empty((self.nodes, len(sizes)), np.int64)
        node[: self.graph.leaves] = by_term[self.term_of]
        for own, a, b in self.levels:
            node[own] = node[a] + node[b]
        out = np.zeros((len(self.graph.parts), len(sizes)), np.int64)
        if len(self.flat):
            out[self.with_parts] = np.add.reduceat(node[self.flat], self.starts, axis=0)
        return out


def _postings(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, tfs) of documents with at least one term; terms are those of the vocabulary."""
    narrow = docs.select(F.col(key).alias("doc"), text_or_empty(text).cast("binary").alias("text"))
    kind = narrow.schema["doc"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches, "text", SLICE_BYTES):
            sizes, found, tfs, ends, keep = [], [], [], [0], []
            for place, raw in enumerate(batch.column(1).to_pylist()):
                words = terms(raw)
                if not words:
                    continue
                counts = Counter(words)
                for word in counts.keys() & known.keys():
                    found.append(known[word])
                    tfs.append(counts[word])
                keep.append(place)
                sizes.append(len(words))
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            yield pa.record_batch({
                "doc": batch.column(0).take(pa.array(keep, pa.int32())), "n": pa.array(sizes, pa.int64()),
                "terms": pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
            })

    return narrow.mapInArrow(run, f"doc {kind}, n long, terms array<int>, tfs array<long>")


def _statistics(postings: DataFrame, words: int) -> tuple[int, int, np.ndarray]:
    """(documents, all their terms, document frequency of each term of the vocabulary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, all_terms, held = 0, 0, np.zeros(words, np.int64)
        for batch in batches:
            documents += batch.num_rows
            all_terms += pc.sum(batch.column(0)).as_py() or 0
            held += np.bincount(batch.column(1).flatten().to_numpy(zero_copy_only=False), minlength=words)
        some = np.flatnonzero(held)
        yield pa.record_batch({"term": pa.array([-2, -1, *some.tolist()], pa.int32()),
                               "n": pa.array([documents, all_terms, *held[some].tolist()], pa.int64())})

    summed = postings.select("n", "terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {row.term: row.n for row in summed.collect()}  # one row per word of the block's queries
    held = np.array([counts.get(t, 0) for t in range(words)], np.int64)
    return counts.get(-2, 0), counts.get(-1, 0), held


def weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


Best = list[tuple[int, bool, object]]  # (-score, key is null, key), best first


def _best(postings: DataFrame, scorer: Scorer, names: list[str], k: int) -> DataFrame:
    """(name, doc, score): the k best documents of each query in each task."""
    kind = postings.schema["doc"].dataType.simpleString()
    sent = postings.sparkSession.sparkContext.broadcast((scorer, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, names = sent.value
        best: list[Best] = [[] for _ in names]
        floor = np.ones(len(names), np.int64)  # a score below it cannot be among the best
        doc_type = pa.null()
        for batch in batches:
            doc_type = batch.schema.field("doc").type
            for start in range(0, batch.num_rows, scorer.rows):
                block = batch.slice(start, scorer.rows)
                # by ascending key, so that of equal scores the earlier one wins
                block = block.take(pc.sort_indices(block.column(0), null_placement="at_end"))
                lists = block.column(2)
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                scores = scorer.scores(
                    block.column(1).to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(block.num_rows), counts),
                    lists.flatten().to_numpy(zero_copy_only=False), block.column(3).flatten().to_numpy(zero_copy_only=False))
                high = scores >= floor[:, None]
                for query in np.flatnonzero(high.any(axis=1)):
                    found = np.flatnonzero(high[query])
                    if len(found) > k:
                        found = found[np.argsort(-scores[query, found], kind="stable")[:k]]
                    keys = [block.column(0)[int(i)].as_py() for i in found]
                    merged = best[query] + [(-int(scores[query, i]), d is None, d) for i, d in zip(found, keys, strict=True)]
                    best[query] = sorted(merged, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]
                    if len(best[query]) == k:
                        floor[query] = -best[query][-1][0]
        rows = [(name, d, -s) for name, own in zip(names, best, strict=True) for s, _, d in own]
        yield pa.record_batch({"name": pa.array([r[0] for r in rows], pa.string()), "doc": pa.array([r[1] for r in rows], doc_type),
                               "score": pa.array([r[2] for r in rows], pa.int64())})

    return postings.where(F.size("terms") > 0).mapInArrow(run, f"name string, doc {kind}, score long")


def search(
    docs: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", query_key: str = "item_id", text: str = "text",
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """(query_key, rank, key, score): for each row of `queries` its k best documents with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    asked = queries.select(F.col(query_key).alias("_query"), text_or_empty(text).alias("_text")).withColumn("_name", F.sha2("_text", 256))
    different = asked.groupBy("_name").agg(F.first("_text").alias("_text"))
    blocks = max(1, math.ceil(different.count() / queries_per_block))
    found = []
    for block in range(blocks):
        rows = different.where(F.pmod(F.xxhash64("_name"), F.lit(blocks)) == block).collect()  # about queries_per_block texts
        rows = sorted(((row._name, terms(row._text.encode())) for row in rows))
        vocabulary = {word: i for i, word in enumerate(sorted({w for _, words in rows for w in words}))}
        if not vocabulary:
            continue
        graph = mine([[vocabulary[w] for w in words] for _, words in rows])
        postings = stage(_postings(docs, key, text, vocabulary), "postings")
        documents, all_terms, held = _statistics(postings, len(vocabulary))
        weights = np.array([weight(documents, int(n)) for n in held], np.int64)
        found.append(_best(postings, Scorer(graph, weights, documents, max(1, all_terms)), [name for name, _ in rows], k))
    kind = docs.schema[key].dataType.simpleString()
    best = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], f"name string, doc {kind}, score long")
    place = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
    ranked = best.withColumn("rank", place).where(F.col("rank") <= k)
    return asked.join(ranked, F.col("_name") == F.col("name")).select(
        F.col("_query").alias(query_key), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(key), "score")
