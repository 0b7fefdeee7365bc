"""Near-duplicates by an inverted join on MinHash signature coordinates, confirmed on full sets.

A document's set has its different shingles of SHINGLE words (A-Z lower-cased); a shorter text is
one shingle. Documents are linked at a Jaccard similarity of at least PERCENT / 100; groups are the
connected components of all links.

1. Equal sets are one class, named by its smallest id; copies are never paired.
2. A class is posted under each coordinate and value of its signature. Values that no other class
   has are dropped; of the others only the rarest are kept: classes that agree in MATCHES of
   COORDINATES values share one of the COORDINATES - MATCHES + 1 rarest of each (the prefix; the
   frequent lists are skipped when merging).
3. In each list all classes are paired with one pivot, the class whose values are the most frequent
   (the likely original). Pairs that agree in at least MATCHES values are confirmed on full sets.
4. Lists whose classes are in one component by now are done, however long. For the classes of the
   other lists, pairs from different components are found by the same prefix rule on the full sets
   (rarest shingles first, with sizes and positions bounding the overlap) and confirmed. No link
   between two components is lost there; nothing is dropped, capped or sampled.

The only chance is in step 2: a pair exactly at the similarity 0.75 agrees in fewer than 30 of 64
values with a probability of about one in a million, closer pairs far less often.

Texts without words, and null texts, have an empty set and are linked with nothing. Rows with a
null id can't be told apart: each is kept, with a null component. Rows that share an id are one
document; where their texts differ, links are confirmed on the first text in order. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices, text_or_empty
from almanac.llm.fingerprints import SLICE_BYTES, _mixed, word_hashes
from almanac.llm.graph import components
from almanac.sources.stage import stage

SHINGLE, PERCENT = 5, 75
COORDINATES, MATCHES = 64, 30
#: Seed of the coordinates' multipliers.
SEED = 7
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's different shingles."""
    ends, words, _ = word_hashes([text.translate(_LOWER) for text in texts])
    sets = []
    for first, last in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        own, n = words[first:last], min(shingle, last - first)
        if n == 0:
            sets.append(np.zeros(0, np.uint64))
            continue
        mixed = _mixed(own[: len(own) - n + 1] + np.uint64(n))
        for place in range(1, n):
            with np.errstate(over="ignore"):
                mixed = _mixed(mixed * np.uint64(3) + own[place : len(own) - n + 1 + place])
        sets.append(np.unique(mixed))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES 32-bit minima for each set that isn't empty."""
    factors = np.random.default_rng(SEED).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    whole = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    with np.errstate(over="ignore"):
        for place, factor in enumerate(factors):
            out[:, place] = np.minimum.reduceat((whole * factor) >> np.uint64(32), starts)
    return out.view(np.int32)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in batches:
        for batch in slices(iter([whole]), "text", SLICE_BYTES):
            yield batch, batch.column(1).cast(pa.binary()).to_pylist()


def _features(docs: DataFrame) -> DataFrame:
    """(id, n, s1, s2, signature): s1 and s2 are sums over the set; signature is null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _parts(batches):
            sets = shingle_sets(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            rows: list = [None] * len(sets)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full]), strict=True):
                    rows[i] = row
            with np.errstate(over="ignore"):
                sums = np.array([[s.sum(dtype=np.uint64), _mixed(s).sum(dtype=np.uint64)] for s in sets], np.uint64).view(np.int64)
            yield pa.record_batch({
                "id": batch.column(0), "n": pa.array([len(s) for s in sets], pa.int64()),
                "s1": pa.array(sums[:, 0]), "s2": pa.array(sums[:, 1]), "signature": pa.array(rows, pa.list_(pa.int32())),
            })

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, s1 long, s2 long, signature array<int>")


def _sets(docs: DataFrame) -> DataFrame:
    """(id, shingles): the sets as sorted hashes, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _parts(batches):
            yield pa.record_batch({"id": batch.column(0), "shingles": pa.array([s.tobytes() for s in shingle_sets(texts)], pa.binary())})

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    first, second = (sets.select(F.col("id").alias(x), F.col("shingles").alias(f"_{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.record_batch({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array(keep))

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.join(first, "a").join(second, "b").select("a", "b", "_a", "_b").mapInArrow(run, f"a {kind}, b {kind}")


def _prefix(listed: DataFrame, total, keep) -> DataFrame:
    """Of (id, key, ...) the rows with keys that several ids have, rarest first; `at` counts the id's other keys before.

    `total` is how many keys an id has, `keep` how many of the rarest stay.
    """
    shared = listed.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    mine = Window.partitionBy("id")
    return (
        listed.join(shared, "key")
        .withColumn("weight", F.sum("held").over(mine))
        .withColumn("at", total - F.count("*").over(mine) + F.row_number().over(mine.orderBy("held", "key")) - 1)
        .where(F.col("at") < keep)
    )


def _differs(a: str, b: str):
    """Sizes so different that the sets can't be similar enough."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(id, component) of the classes that are linked to others."""
    places = F.posexplode("signature").alias("_place", "_value")
    listed = classes.select("id", "n", places).select(
        "id", "n", F.shiftleft(F.col("_place").cast("long"), 32).bitwiseOR(F.col("_value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))
    posts = stage(_prefix(listed, F.lit(COORDINATES), F.lit(COORDINATES - MATCHES + 1)).select("key", "id", "n", "weight"), "posts")
    used = posts.select("id").distinct()
    # Combined before the shuffle, so that many rows of one id are no hot key.
    first = docs.groupBy("id").agg(F.min("text").alias("text"))
    sets = stage(_sets(first.join(used, "id", "left_semi")), "sets")

    pivots = posts.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("_minus"), F.col("n").alias("_n"))).alias("_pivot"))
    stars = (
        posts.join(pivots, "key")
        .select(F.least("id", -F.col("_pivot._minus")).alias("a"), F.greatest("id", -F.col("_pivot._minus")).alias("b"), "n", "_pivot._n")
        .where((F.col("a") < F.col("b")) & _differs("n", "_n")).select("a", "b").distinct()
    )
    one, other = (classes.select(F.col("id").alias(x), F.col("signature").alias(f"_{x}")) for x in "ab")
    agree = F.size(F.expr("filter(zip_with(_a, _b, (x, y) -> x = y), same -> same)"))
    alike = stars.join(one, "a").join(other, "b").where(agree >= MATCHES).select("a", "b")
    links = stage(_confirmed(alike, sets), "links")

    found = components(links, "a", "b")
    labelled = posts.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    open_lists = labelled.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low < _high")
    open_ids = stage(labelled.join(open_lists, "key", "left_semi").select("id", "component").distinct(), "open")
    return components(links.union(_cross_links(open_ids, sets)), "a", "b")


def _cross_links(ids: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between classes of different components among `ids` (id, component), by prefixes of the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "shingles", SLICE_BYTES):
                rows = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column(2)]
                sizes = np.array([len(r) for r in rows], np.int64)
                at = pa.array(np.repeat(np.arange(len(rows)), sizes))
                yield pa.record_batch({
                    "id": batch.column(0).take(at), "component": batch.column(1).take(at),
                    "n": pa.array(np.repeat(sizes, sizes)), "key": pa.array(np.concatenate(rows)),
                })

    kind = ids.schema["id"].dataType.simpleString()
    listed = ids.join(sets, "id").select("id", "component", "shingles").mapInArrow(run, f"id {kind}, component {kind}, n long, key long")
    keep = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    posts = stage(_prefix(listed, F.col("n"), keep).select("key", "id", "component", "n", "at"), "rare")
    left, right = posts.alias("l"), posts.alias("r")
    rest = F.least(F.col("l.n") - F.col("l.at"), F.col("r.n") - F.col("r.at"))
    near = (
        (F.col("l.key") == F.col("r.key")) & (F.col("l.id") < F.col("r.id")) & (F.col("l.component") != F.col("r.component"))
        & _differs("l.n", "r.n") & ((100 + PERCENT) * rest >= PERCENT * (F.col("l.n") + F.col("r.n")))
    )
    pairs = left.join(right, near).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()
    return stage(_confirmed(pairs, sets), "cross")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("text"))
    features = stage(_features(narrow), "features")
    alike = ["n", "s1", "s2"]
    usable = features.where("n > 0 AND id IS NOT NULL")
    first = F.min_by("signature", "id").alias("signature")
    classes = stage(usable.groupBy(*alike).agg(F.min("id").alias("id"), first), "classes")
    linked = _links(narrow.where("id IS NOT NULL"), classes)
    named = classes.join(linked, "id", "left").select(*alike, F.coalesce("component", "id").alias("component_id"))
    with_class = features.where("n > 0 AND id IS NOT NULL").join(named, alike, "left").select("id", "n", "component_id")
    alone = features.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return with_class.union(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id",
        (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one of each component, that with the smallest key (null last).

    Texts are compared, whatever their keys: each stands for itself under a hash of its own, so rows with one key or
    with none are told apart by text. Texts without words are linked with nothing and all stay.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    rows = rows.select("_doc", F.col(f"_doc.`{key}`").alias("_key"), F.col(f"_doc.`{text}`").alias("_text")).withColumn("_text_id", F.xxhash64("_text"))
    named = near_duplicates(rows.select("_text_id", "_text"), "_text_id", "_text").where("n_shingles > 0")
    named = stage(named.select(F.col("_text_id").alias("_of"), F.col("component_id").alias("_component")).distinct(), "components")
    best = F.min(F.struct(F.col("_key").isNull().alias("null"), F.col("_key").alias("key"), F.col("_of").alias("of"))).alias("_best")
    first = rows.select("_key", "_text_id").join(named, F.col("_text_id") == F.col("_of")).groupBy("_component").agg(best)
    first = stage(first.select(F.col("_best.key").alias("_best_key"), F.col("_best.of").alias("_best_of")), "kept")
    chosen = rows.join(first, F.col("_key").eqNullSafe(F.col("_best_key")) & (F.col("_text_id") == F.col("_best_of")))
    kept = chosen.groupBy("_key", "_text_id").agg(F.first("_doc").alias("_doc"))  # rows that are alike
    wordless = rows.join(named, F.col("_text_id") == F.col("_of"), "left_anti")
    return kept.select("_doc.*").unionByName(wordless.select("_doc.*"))
