"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters counts as one gap, and all n-grams of one
to three code points are hashed into buckets. Counts per language are summed by Spark; the matrix
of log probabilities (languages x buckets) is broadcast; a text's score is the sum of its
n-grams' columns, made for a batch at once in numpy.

Null text, or text without a letter: `und`, score 0. Equal scores: the first language by code
point. Without learnable rows every text is `und`. Repeated rows give a row each; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices, text_or_empty

BUCKETS = 1 << 16
ORDERS = 3
#: Labelled rows of each language, about, that the model is fitted on: chosen by a hash of the id, whole texts.
TRAIN_ROWS = 5_000
#: Languages, at most: 128 MB of log probabilities.
MOST_LANGUAGES = 500
#: Added to every count.
SMOOTHING = 0.5
UNKNOWN = "und"
#: Fixed odd multipliers of the hash, one for each place in an n-gram.
PLACES = (2654435761, 2246822519, 3266489917)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all n-grams, one pair of arrays for each length; grams of gaps alone are left out."""
    lowered = pc.utf8_lower(texts).to_pylist()
    # Every text ends in a gap, wherever it stands in the batch.
    points = np.frombuffer("".join(f"{text}\n" for text in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    letter = _letters()[points]
    keep = letter | np.append(False, letter[:-1])
    at = np.repeat(np.arange(len(lowered), dtype=np.int32), lengths)[keep]
    points = np.where(letter, points, 0)[keep]
    mixed = np.zeros(len(points), np.uint32)
    for order in range(ORDERS):
        n = len(points) - order
        if n <= 0:
            return
        with np.errstate(over="ignore"):
            mixed = mixed[:n] + (points[order:] + np.uint32(1)) * np.uint32(PLACES[order] & 0xFFFFFFFF)
            hashed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822507)
        inside = (at[:n] == at[order:]) & (points[:n] != 0) if order == 0 else at[:n] == at[order:]
        yield at[:n][inside], (hashed >> np.uint32(16))[inside].astype(np.int32) & (BUCKETS - 1)


def train(rows: DataFrame, lang: str = "lang", text: str = "text", prior: dict[str, int] | None = None) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities (languages x buckets), the last column being the prior) from labelled rows.

    `prior`: rows of each language among all, where `rows` is a sample that does not keep their shares.
    """
    ship(rows.sparkSession)
    labelled = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            coded = batch.column(0).dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for name in names:
                counts.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
            for i, name in enumerate(names):
                counts[name][BUCKETS] += int((codes == i).sum())
            for at, bucket in grams(batch.column(1)):
                both = np.bincount(codes[at] * np.int64(BUCKETS) + bucket, minlength=len(names) * BUCKETS)
                for i, name in enumerate(names):
                    counts[name][:BUCKETS] += both[i * BUCKETS : (i + 1) * BUCKETS]
        for name, own in counts.items():
            seen = np.flatnonzero(own)
            yield pa.record_batch({"lang": pa.array([name] * len(seen)), "bucket": pa.array(seen.astype(np.int32)), "n": pa.array(own[seen])})

    found = labelled.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    counts = np.zeros((len(langs), BUCKETS + 1))
    if langs:
        place = {name: i for i, name in enumerate(langs)}
        counts[[place[x] for x in found["lang"].to_pylist()], found["bucket"].to_numpy()] = found["n"].to_numpy()
        if prior is not None:
            counts[:, BUCKETS] = [prior[name] for name in langs]
        share = counts[:, BUCKETS:] / counts[:, BUCKETS:].sum()
        smooth = counts[:, :BUCKETS] + SMOOTHING
        counts = np.log(np.hstack([smooth / smooth.sum(axis=1, keepdims=True), share]))
    return langs, counts.astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score."""
    spark = docs.sparkSession
    ship(spark)
    langs, weights = model
    sent = spark.sparkContext.broadcast(weights)
    narrow = docs.select(*keep, text_or_empty(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = sent.value
        for batch in slices(batches, "_text"):
            n = batch.num_rows
            total = np.repeat(matrix[:, -1:].astype(float), n, axis=1)
            seen = np.zeros(n, np.int64)
            for at, bucket in grams(batch.column(len(keep))):
                first = np.flatnonzero(np.diff(at, prepend=-1))
                if not len(first):
                    continue
                seen[at[first]] += 1
                for i in range(len(langs)):
                    total[i, at[first]] += np.add.reduceat(matrix[i][bucket], first, dtype=np.float64)
            known = (seen > 0) & bool(langs)
            if langs:
                best = np.argmax(total, axis=0)
                share = np.exp(total - total.max(axis=0))
                score = np.where(known, 1 / share.sum(axis=0), 0.0)
                names = np.where(known, np.array(langs, object)[best], UNKNOWN)
            else:
                score, names = np.zeros(n), np.full(n, UNKNOWN, object)
            yield pa.record_batch({
                **{name: batch.column(i) for i, name in enumerate(keep)},
                "lang_pred": pa.array(names.tolist(), pa.string()), "score": pa.array(score, pa.float64()),
            })

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, f"{schema}, lang_pred string, score double")


def row_counts(docs: DataFrame, learnable: Column, lang: str = "lang") -> dict[str, int]:
    """Learnable rows of each language; ValueError beyond MOST_LANGUAGES, whose matrix would be too large to send."""
    found = docs.where(learnable & F.col(lang).isNotNull()).groupBy(lang).count().limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {row[0]: row["count"] for row in found}


def training_sample(docs: DataFrame, learnable: Column, counts: dict[str, int], key: str = "doc_id", lang: str = "lang", rows: int = TRAIN_ROWS) -> DataFrame:
    """Of each language about `rows` of its learnable rows, all where it has fewer than twice as many, by a hash of the key."""
    steps = docs.sparkSession.createDataFrame([(name, max(1, n // max(1, rows))) for name, n in counts.items()], "_lang string, _step long")
    chosen = docs.where(learnable & F.col(key).isNotNull()).join(F.broadcast(steps), F.col(lang) == F.col("_lang"))  # MOST_LANGUAGES rows
    return chosen.where(F.pmod(F.xxhash64(F.col(key)), F.col("_step")) == 0).drop("_lang", "_step")
