"""Toxicity by the nearest labelled examples under the exact cosine of supervised TF-IDF weights.

Terms are runs of letters, lower-cased. The index holds at most PER_CLASS examples of each label
and every term of theirs; none is left out. A term weighs its inverse document frequency, counted
over all documents, times the standard errors by which its shares in the two labels differ, where
that is more than one. Words that no example holds count in a text's length, each as a word that no
other document has.

Every text that shares a term with an example is searched. A term's examples are a posting list;
the lists of the DENSE most frequent terms are kept as rows with their largest weight in each block
of examples. The other lists are summed, the blocks' largest weights bound what the rows can add,
and only examples whose bound reaches the K-th best cosine are summed up: the neighbours are exact.

The K neighbours vote with their cosines as weights, set right for the share of each label in the
whole training part; the label's overall share votes with a fixed small weight. A text that shares
no term with any example gets that share as its score, as do null and empty texts. With no
usable label every score is 0. Equal cosines: the example with the smaller doc_id. Repeated rows
give a row each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices, text_or_empty

#: Labelled examples of each label in the index, at most; chosen by a hash of the id, whole texts.
PER_CLASS = 2_000
#: Posting lists kept as rows of all examples, at most: the longest, of at least 1 / SHORT of the examples. Speed only.
DENSE, SHORT = 1_000, 6
#: Most frequent terms that examples are put in order by. Speed only.
FREQUENT = 24
#: Nearest examples that vote; examples in a block, and blocks looked at before any is ruled out; weight of the label's overall share.
NEIGHBOURS = 15
BLOCK, FIRST = 64, 4
PRIOR_WEIGHT = 0.25
#: Weight of the root of what a text's words outside the index come to.
OTHERS_WEIGHT = 1.0
THRESHOLD = 0.5


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text number, word number, times) by text and word, and the words."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL]+", " ")
    split = pc.ascii_split_whitespace(spaced)
    words = split.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    held = pc.not_equal(words, "")
    coded = words.filter(held).dictionary_encode()
    size = max(1, len(coded.dictionary))
    both, times = np.unique(owner[held.to_numpy(zero_copy_only=False)] * size + coded.indices.to_numpy(), return_counts=True)
    return both // size, both % size, times, coded.dictionary


def words_in(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term number, times) for the terms of the vocabulary, by text; and for the other words of each text the sum of (1 + log times) squared."""
    at, word, times, words = words_of(texts)
    found = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy()[word].astype(np.int64)
    held = found >= 0
    others = np.bincount(at[~held], weights=(1 + np.log(times[~held])) ** 2, minlength=len(texts))
    return at[held], found[held], times[held], others


@dataclass
class Postings:
    """Term x example: lists of (example, value) from start[term] to start[term + 1]; or, where `place` is not negative, a row, with the blocks' largest values in `best`."""

    start: np.ndarray
    example: np.ndarray
    value: np.ndarray
    place: np.ndarray
    rows: np.ndarray
    best: np.ndarray

    def __getitem__(self, terms: np.ndarray) -> np.ndarray:
        """The terms' rows in full; a last one past all terms, for words outside the index, is 0."""
        out = np.zeros((len(terms), self.rows.shape[1]))
        for row, term in zip(out, terms, strict=True):
            own = slice(self.start[term], self.start[term + 1])
            row[self.example[own]] = self.value[own]
            if self.place[term] >= 0:
                row[:] = self.rows[self.place[term]]
        return out


def _postings(term: np.ndarray, example: np.ndarray, value: np.ndarray, n_terms: int, n_examples: int) -> Postings:
    blocks = max(1, -(-n_examples // BLOCK))
    held = np.bincount(term, minlength=n_terms + 1)
    longest = np.argsort(-held, kind="stable")[:DENSE]
    longest = longest[held[longest] >= max(1, n_examples / SHORT)]
    place = np.full(n_terms + 1, -1, np.int64)
    place[longest] = np.arange(len(longest))
    rows = np.zeros((len(longest), blocks * BLOCK))
    dense = place[term] >= 0
    rows[place[term[dense]], example[dense]] = value[dense]
    term, example, value = term[~dense], example[~dense], value[~dense]
    order = np.lexsort((example, term))
    start = np.append(0, np.cumsum(np.bincount(term, minlength=n_terms + 1)))
    return Postings(start, example[order], value[order], place, rows, rows.reshape(len(rows), blocks, BLOCK).max(axis=2))


@dataclass
class Index:
    """terms and their weights (`idf`); examples, like ones side by side, and their `rank` by id; other_weight: of a word that no example holds."""

    terms: pa.Array
    idf: np.ndarray
    weights: Postings
    ids: np.ndarray
    rank: np.ndarray
    toxic: np.ndarray
    vote: np.ndarray
    share: float
    other_weight: float

    def nearest(self, terms: np.ndarray, times: np.ndarray, others: float = 0, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(example numbers, cosines) of the k nearest with a cosine above 0, nearest first."""
        held = self.weights
        query = (1 + np.log(times)) * self.idf[terms]
        query /= np.sqrt(query @ query + OTHERS_WEIGHT**2 * others)
        place = held.place[terms]
        lists, dense = terms[place < 0], place[place >= 0]
        start = held.start[lists]
        lengths = held.start[lists + 1] - start
        entries = np.repeat(start - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        summed = np.bincount(held.example[entries], held.value[entries] * np.repeat(query[place < 0], lengths), held.rows.shape[1])
        own = query[place >= 0]
        # Blocks from the best bound down: a few for a first K-th best, then those that can still reach it.
        bounds = summed.reshape(-1, BLOCK).max(axis=1) + own @ held.best[dense]
        order = np.argsort(-bounds, kind="stable")
        found, scores = self._summed(order[:FIRST], summed, own, dense)
        if len(scores) > k and len(order) > FIRST:
            least = np.partition(scores, -k)[-k]
            more, other = self._summed(order[FIRST:][bounds[order[FIRST:]] >= least - 1e-9], summed, own, dense)
            found, scores = np.append(found, more), np.append(scores, other)
        if len(scores) > k:
            near = scores >= np.partition(scores, -k)[-k] - 1e-9
            found, scores = found[near], scores[near]
        found, scores = found[scores > 0], scores[scores > 0]
        top = np.lexsort((self.rank[found], -np.round(scores, 12)))[:k]
        return found[top], scores[top]

    def _summed(self, blocks: np.ndarray, summed: np.ndarray, own: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the blocks, and their cosines."""
        rows = self.weights.rows.reshape(*self.weights.best.shape, BLOCK)[dense[:, None], blocks]
        found = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        return found, summed[found] + own @ rows.reshape(len(dense), len(found))

    def score(self, found: np.ndarray, cosines: np.ndarray) -> float:
        votes = cosines * self.vote[found]
        return float((votes @ self.toxic[found] + PRIOR_WEIGHT * self.share) / (votes.sum() + PRIOR_WEIGHT))


def document_frequencies(docs: DataFrame, vocabulary: pa.Array, text: str = "text") -> tuple[np.ndarray, int]:
    """How many documents hold each term, and how many there are; each task sends a term once."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros(len(sent.value) + 1, np.int64), 0
        for batch in slices(batches, "_text"):
            _, terms, _, _ = words_in(batch.column(0), sent.value)
            held += np.bincount(terms, minlength=len(held))
            rows += batch.num_rows
        held[-1] = rows
        some = np.flatnonzero(held)
        yield pa.record_batch({"_term": pa.array(some), "_held": pa.array(held[some])})

    texts = docs.select(F.col(text).cast("string").alias("_text")).where("_text IS NOT NULL")
    counted = texts.mapInArrow(run, "_term long, _held long").groupBy("_term").agg(F.sum("_held").alias("_held")).toArrow()
    held = np.zeros(len(vocabulary) + 1, np.int64)
    held[counted["_term"].to_numpy()] = counted["_held"].to_numpy()
    return held[:-1], int(held[-1])


def build_index(docs: DataFrame, labels: DataFrame, learnable: Column, key: str = "doc_id", label: str = "toxic",
                text: str = "text", per_class: int = PER_CLASS) -> Index:
    """The index from labelled rows; `learnable` is a condition on the key."""
    ship(docs.sparkSession)
    marked = (
        labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_toxic"))
        .where(F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1))
        .groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
        .withColumnRenamed("_id", key).where(learnable).withColumnRenamed(key, "_id")
    )
    totals = {row._toxic: row["count"] for row in marked.groupBy("_toxic").count().collect()}
    chosen = [marked.where(F.col("_toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)]
    sample = chosen[0].union(chosen[1])
    examples = (
        docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text")).where("_text IS NOT NULL")
        .join(F.broadcast(sample), "_id").select("_id", "_toxic", "_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            at, word, times, words = words_of(batch.column(2))
            at = pa.array(at)
            yield pa.record_batch({"_id": batch.column(0).take(at), "_toxic": batch.column(1).take(at),
                                   "_word": words.take(pa.array(word)), "_times": pa.array(times)})

    kind = examples.schema["_id"].dataType.simpleString()
    entries = examples.mapInArrow(run, f"_id {kind}, _toxic int, _word string, _times long")
    found = entries.groupBy("_id", "_word").agg(F.max("_toxic").alias("_toxic"), F.max("_times").alias("_times")).toArrow()
    ids, at = _numbered(found["_id"])
    terms, term = _numbered(found["_word"])
    vocabulary = pa.array(terms, pa.string())
    rank = _side_by_side(term, at, len(terms), len(ids))
    ids, at = np.array(ids, dtype=object)[rank], np.argsort(rank)[at]
    toxic = np.zeros(len(ids))
    toxic[at] = found["_toxic"].to_numpy()
    n = np.array([(toxic == c).sum() for c in (0, 1)])
    held, rows = document_frequencies(docs, vocabulary, text)
    idf = (np.log((1 + rows) / (1 + held)) + 1) * np.maximum(1.0, _apart(np.bincount(term, toxic[at], len(terms)), np.bincount(term, minlength=len(terms)), n))
    value = (1 + np.log(found["_times"].to_numpy())) * idf[term]
    value /= np.sqrt(np.bincount(at, value**2, len(ids)))[at]
    all_rows = sum(totals.values())
    vote = np.array([totals.get(c, 0) / max(1, n[c]) for c in (0, 1)])
    vote = vote / max(vote.max(), 1e-12)
    return Index(vocabulary, idf, _postings(term, at, value, len(terms), len(ids)), ids, rank, toxic,
                 vote[toxic.astype(int)], totals.get(1, 0) / all_rows if all_rows else 0.0, np.log((1 + rows) / 2) + 1)


def _numbered(values: pa.ChunkedArray) -> tuple[list, np.ndarray]:
    """The different values in order, and the number of each row's."""
    coded = pa.concat_arrays(values.chunks or [pa.array([], values.type)]).dictionary_encode()
    different = coded.dictionary.to_pylist()
    order = sorted(range(len(different)), key=different.__getitem__)
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return [different[i] for i in order], rank[coded.indices.to_numpy()]


def _side_by_side(term: np.ndarray, example: np.ndarray, n_terms: int, n_examples: int) -> np.ndarray:
    """Examples in an order by which of the most frequent terms they hold, so that blocks are of like ones and their bounds are near."""
    frequent = np.argsort(-np.bincount(term, minlength=n_terms), kind="stable")[:FREQUENT]
    holds = np.zeros((len(frequent) + 1, n_examples), bool)
    for row, own in zip(holds, frequent, strict=False):
        row[example[term == own]] = True
    return np.lexsort(holds[::-1])


def _apart(toxic: np.ndarray, held: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How far apart the shares of terms in the two labels are, in standard errors; 0 with examples of one label only."""
    if not n.all():
        return np.zeros(len(held))
    pooled = held / n.sum()
    error = np.sqrt(pooled * (1 - pooled) * (1 / n).sum())
    return np.divide(np.abs(toxic / n[1] - (held - toxic) / n[0]), error, out=np.zeros(len(held)), where=error > 0)


def _judged(index: Index, texts: pa.Array) -> tuple[np.ndarray, list[list[str]]]:
    """Scores, and the ids of the nearest examples, of texts without nulls."""
    at, terms, times, others = words_in(texts, index.terms)
    others = others * index.other_weight**2
    scores, evidence = np.full(len(texts), index.share), [[] for _ in range(len(texts))]
    start = 0
    for end in np.flatnonzero(np.diff(np.append(at, -1))) + 1:
        found, cosines = index.nearest(terms[start:end], times[start:end], others[at[start]])
        scores[at[start]] = index.score(found, cosines)
        evidence[at[start]] = [str(x) for x in index.ids[found]]
        start = end
    return scores, evidence


def score(docs: DataFrame, index: Index, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The kept columns, score, predicted and `evidence`: ids of the nearest examples, nearest first."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(index)
    narrow = docs.select(*keep, text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            scores, evidence = _judged(sent.value, batch.column(len(keep)))
            yield pa.record_batch({
                **{name: batch.column(i) for i, name in enumerate(keep)},
                "score": pa.array(scores), "predicted": pa.array((scores >= threshold).astype(np.int32)),
                "evidence": pa.array(evidence, pa.list_(pa.string())),
            })

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, f"{schema}, score double, predicted int, evidence array<string>")


def without_toxic(docs: DataFrame, index: Index, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a score below the threshold, with all their columns."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = pc.fill_null(pc.cast(batch.column(batch.schema.get_field_index(text)), pa.string()), "")
            scores, _ = _judged(sent.value, texts)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
