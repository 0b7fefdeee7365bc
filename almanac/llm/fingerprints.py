"""SimHash fingerprints, a text's neighbour in descending order of id, and search within a Hamming radius.

A fingerprint has 64 bits. Terms are pairs of neighbouring words (the word itself where there is
only one). Each time a pair occurs its 64-bit hash votes on every bit, for it where the hash has a
one and against it elsewhere, with the pair's length in bytes as weight (long words are rare
words). A bit is one where the votes for it prevail. Equal texts have equal fingerprints; a text
without words has all bits zero.

`within` finds pairs at a Hamming distance of at most r: with b > r blocks, two fingerprints that
differ in r bits agree in b - r whole blocks, so each is listed under every choice of b - r blocks
(the permuted tables); tables are joined on those bits and distances are checked. Equal
fingerprints are one entry with a count, so copies are not expanded. `near_counts` asks this for
stated rows against all rows.

`with_next` pairs a row with the row after it in descending order of id (after the last, the
first) without a sort in one task: ids are cut into ranges, each range also gets the first rows of
the range after it, and the rows are led within their range. Rows with equal ids follow each other
by text; null ids come last. An empty table gives no rows; null text counts as empty; repeated
rows are rows of their own; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices, text_or_empty
from almanac.sources.stage import stage

BITS = 64
#: Bytes of text whose words are hashed at once, about; bounds memory.
SLICE_BYTES = 1 << 19
#: Ranges of ids for each shuffle partition, so that partitions come out even.
RANGES_PER_TASK = 3
#: Fixed odd numbers: the polynomial's base, and the multipliers of the mixing steps.
BASE, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX_A)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(33))


@cache
def _byte_values() -> np.ndarray:
    return _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE >> 1 | 1))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for number in (BASE, pow(BASE, -1, 1 << 64)):
            row = np.full(size, number, np.uint64)
            row[0] = 1
            with np.errstate(over="ignore"):
                both.append(np.multiply.accumulate(row))
        _powers[size] = (both[0], both[1])
    return _powers[size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, hashes, lengths): 64-bit hashes and bytes of the words of each text."""
    raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    stops = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.searchsorted(starts, np.append(0, np.cumsum(sizes + 1)))
    hashes = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(stops, starts[first] + SLICE_BYTES, side="right")))
        low, high = int(starts[first]), int(stops[last - 1])
        power, inverse = _powers_to(high - low)
        with np.errstate(over="ignore"):
            sums = np.append(np.uint64(0), np.cumsum(_byte_values()[raw[low:high]] * power[: high - low]))
            hashes[first:last] = (sums[stops[first:last] - low] - sums[starts[first:last] - low]) * inverse[starts[first:last] - low]
        first = last
    return ends, _mixed(hashes), stops - starts


def simhash(texts: list[bytes]) -> np.ndarray:
    """A 64-bit fingerprint for each text."""
    ends, hashes, lengths = word_hashes(texts)
    n = len(texts)
    counts = np.diff(ends)
    at = np.repeat(np.arange(n), counts)
    with np.errstate(over="ignore"):
        paired = np.append(_mixed(hashes[:-1] * np.uint64(3) + hashes[1:]), np.uint64(0)) if len(hashes) else hashes
    weights = lengths + np.append(lengths[1:], 0)
    last = np.zeros(len(hashes), bool)
    last[ends[1:][counts > 0] - 1] = True
    alone = counts[at] == 1
    terms, weights = np.where(alone, hashes, paired), np.where(alone, lengths, weights)
    use = ~last | alone
    terms, weights, at = terms[use], weights[use].astype(float), at[use]
    total = np.bincount(at, weights, minlength=n)
    parts = np.ascontiguousarray(terms.astype("<u8")).view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(float)
    out = np.zeros((n, 8), np.uint8)
    for place in range(8):
        votes = np.bincount(at * 256 + parts[:, place], weights, minlength=n * 256).reshape(n, 256) @ bits
        out[:, place] = np.packbits(2 * votes > total[:, None], axis=1, bitorder="little")[:, 0]
    return out.view("<u8").reshape(n)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of fingerprints."""
    return 1 - np.bitwise_count(a ^ b) / BITS


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, next): each row's text and the text of the row after it."""
    spark = docs.sparkSession
    ship(spark)
    lowest = -(1 << 63)
    narrow = docs.select(F.col(key), text_or_empty(text).alias("text"), F.coalesce(F.col(key).cast("long"), F.lit(lowest)).alias("_id"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = stage(narrow.select("_id"), "ids")
    tops = sorted(row.top for row in ids.repartitionByRange(RANGES_PER_TASK * tasks, "_id").groupBy(F.spark_partition_id()).agg(
        F.max("_id").alias("top")).collect())
    own = len(tops) - 1 - _below(tops, F.col("_id"))
    place = lambda r, turn: F.struct(r.cast("int").alias("range"), F.lit(turn).alias("turn"))
    # the first row of a range, its largest id, also ends the range before it
    both = F.array(place(own, 0), place(F.pmod(own - 1, F.lit(max(1, len(tops)))), 1))
    in_range = Window.partitionBy("_range").orderBy("_turn", F.desc("_id"), "text")
    return (
        narrow.withColumn("_at", F.explode(F.when(F.col("_id").isin(tops), both).otherwise(F.array(place(own, 0)))))
        .select(key, "text", "_id", F.col("_at.range").alias("_range"), F.col("_at.turn").alias("_turn"))
        .withColumn("next", F.lead("text").over(in_range))
        .where("_turn = 0")
        .select(key, "text", "next")
    )


def _below(tops: list[int], value: Column) -> Column:
    """How many of the sorted numbers are less: by the last of each group, then inside one group."""
    width = max(1, math.isqrt(len(tops)))
    groups = [tops[i : i + width] for i in range(0, len(tops), width)]
    less = lambda numbers: F.size(F.filter(numbers, lambda t: t < value))
    whole = less(F.array(*[F.lit(g[-1]).cast("long") for g in groups[:-1]]).cast("array<long>"))
    inside = F.element_at(F.array(*[F.array(*[F.lit(t).cast("long") for t in g]) for g in groups or [[0]]]), whole + 1)
    return whole * width + less(inside)


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row."""
    pairs = with_next(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "text", SLICE_BYTES):
                own, after = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(own, after, strict=True)]
                place: dict[str, int] = {}
                for one in (*own, *after, *edited):
                    place.setdefault(one, len(place))
                raw = [one.encode("utf-8", "surrogatepass") for one in place]
                prints = _in_parts(raw)
                a, b, c = (prints[[place[one] for one in column]] for column in (own, edited, after))
                yield pa.record_batch({
                    key: batch.column(0),
                    "n_chars": pa.array([len(one) for one in own], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(raw[place[one]]).hexdigest() for one in edited]),
                    "fingerprint": pa.array([f"{x:016x}" for x in a.tolist()], pa.string()),
                    "edited_fingerprint": pa.array([f"{x:016x}" for x in b.tolist()], pa.string()),
                    "near_edited": pa.array(likeness(a, b)), "near_next": pa.array(likeness(a, c)),
                })

    kind = pairs.schema[key].dataType.simpleString()
    return pairs.mapInArrow(run, f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")


def _in_parts(raw: list[bytes]) -> np.ndarray:
    """Fingerprints, made for about SLICE_BYTES of text at a time."""
    parts, start, held = [], 0, 0
    for i, one in enumerate(raw):
        if held and held + len(one) > SLICE_BYTES:
            parts.append(simhash(raw[start:i]))
            start, held = i, 0
        held += len(one)
    return np.concatenate([*parts, simhash(raw[start:])]) if raw else np.zeros(0, np.uint64)


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint as a long) for every row."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col(key), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            raw = [one.encode("utf-8", "surrogatepass") for one in batch.column(1).to_pylist()]
            yield pa.record_batch({key: batch.column(0), "fingerprint": pa.array(_in_parts(raw).view(np.int64))})

    return narrow.mapInArrow(run, f"`{key}` {narrow.schema[key].dataType.simpleString()}, fingerprint long")


def block_tables(fingerprint: str, radius: int, blocks: int) -> Column:
    """The keys under which a fingerprint is listed: the bits of each choice of blocks - radius blocks, and the choice."""
    return F.transform(_masks(radius, blocks), lambda mask, number: F.struct(
        number.alias("table"), F.col(fingerprint).bitwiseAND(mask).alias("bits")))


def _masks(radius: int, blocks: int) -> Column:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])


def within(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(query, found, distance, n): for each different `fingerprint` of queries, those of `prints` within the radius and their row counts."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("0 <= radius < blocks <= 64 is needed")

    def listed(different: DataFrame) -> DataFrame:
        return different.select("*", F.explode(block_tables("fingerprint", radius, blocks)).alias("_key")).select("*", "_key.*").drop("_key")

    left = listed(queries.select("fingerprint").where("fingerprint IS NOT NULL").distinct()).withColumnRenamed("fingerprint", "query")
    right = listed(prints.where("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.count("*").alias("n"))).withColumnRenamed("fingerprint", "found")
    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.array_position(F.transform(_masks(radius, blocks), lambda m: differ.bitwiseAND(m) == 0), F.lit(True)) - 1
    # a pair meets in every table whose blocks are equal and is taken in the first of these
    return (
        left.hint("merge").join(right, ["table", "bits"])  # neither side is bounded
        .withColumn("distance", F.bit_count(differ)).where((F.col("distance") <= radius) & (F.col("table") == first))
        .select("query", "found", "distance", "n")
    )


def near_counts(docs: DataFrame, asked: Column, radius: int = 3, fingerprint: str = "fingerprint", name: str = "n_near") -> DataFrame:
    """`docs` with the number of other rows within the radius of a row's fingerprint (16 hex digits), for the rows `asked` for; null for others.

    `docs` must be cheap to read more than once.
    """
    number = F.conv(F.col(fingerprint), 16, -10).cast("long")
    found = within(docs.where(asked).select(number.alias("fingerprint")), docs.select(number.alias("fingerprint")), radius)
    counts = found.groupBy(F.lpad(F.lower(F.hex("query")), 16, "0").alias("_print")).agg((F.sum("n") - 1).alias("_n"))
    rows = docs.hint("merge").join(counts, F.col(fingerprint) == F.col("_print"), "left")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.when(asked, F.col("_n")).alias(name))
