"""Packing of token pieces into windows: non-negative least squares on the histogram of lengths.

1. Every text is encoded, closed by an end id and cut: whole windows, then as many grid units
   as still fit, then a tail of less than a unit. A piece depends on its text alone.
2. The histogram of lengths has at most `window` rows, whatever the corpus. Short combinations of
   grid lengths that fill a window exactly are enumerated; non-negative least squares finds how
   often to repeat each to use up the histogram; repeats are rounded down.
3. What the rounded solution leaves over, and the tails, are packed greedily, largest first,
   still on the histogram.
4. A piece's number among the pieces of its length says which combination, and which repeat, it
   belongs to. Numbers are made per (length, salt) with as many salts as the largest length needs,
   so no task sees all pieces of a frequent length.

Null and empty texts are one piece, the end id. Repeated rows are packed each for itself; rows that
agree in everything are interchangeable. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import ship, slices, text_or_empty
from almanac.llm.encoding import worker_encoder
from almanac.sources.stage import stage

WINDOW, GRID, DEPTH, END_ID = 4096, 64, 5, 2
#: Pieces of one length that one task numbers, about.
SALT_ROWS = 100_000
#: Columns of a piece beside the key.
PIECE_COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                 grid: int = GRID, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens) for each piece; with_ids adds its ids and `document`, a hash that tells texts of one key apart."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col(key), text_or_empty(text).alias("text"), F.xxhash64(text_or_empty(text)).alias("document"))
    kind = narrow.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for batch in slices(batches, "text"):
            ends, ids = encoder.encode(batch.column(1))
            rows, starts, lengths, crcs, totals, kept = [], [], [], [], [], []
            for row in range(batch.num_rows):
                own = np.append(ids[ends[row] : ends[row + 1]], np.uint32(end_id)).astype("<u4")
                raw = memoryview(own).cast("B")
                for a, b in cuts(len(own), window, grid):
                    rows.append(row)
                    starts.append(a)
                    lengths.append(b - a)
                    crcs.append(zlib.crc32(raw[4 * a : 4 * b]))
                    totals.append(len(own))
                if with_ids:
                    kept.append(own)
            columns = {
                key: batch.column(0).take(pa.array(rows, pa.int64())), "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()),
                "doc_tokens": pa.array(totals, pa.int64()),
            }
            if with_ids:
                offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
                flat = np.concatenate([np.zeros(0, "<u4"), *kept]).astype(np.int32)
                columns |= {"document": batch.column(2).take(pa.array(rows, pa.int64())), "ids": pa.ListArray.from_arrays(offsets, pa.array(flat))}
            yield pa.record_batch(columns)

    more = ", document long, ids array<int>" if with_ids else ""
    return narrow.mapInArrow(run, f"`{key}` {kind}, {PIECE_COLUMNS}{more}")


def cuts(n: int, window: int, grid: int) -> list[tuple[int, int]]:
    """Whole windows, then whole grid units, then the tail."""
    at = list(range(0, n - n % window + 1, window))
    rest = n % window
    if rest >= grid:
        at.append(at[-1] + rest - rest % grid)
    if at[-1] < n:
        at.append(n)
    return list(zip(at, at[1:], strict=False))


def combinations(units: int, depth: int) -> np.ndarray:
    """Rows: how often each of 1 .. units - 1 occurs in a sum of 2 to `depth` terms that makes `units`."""
    found: list[list[int]] = []

    def extend(terms: list[int], left: int) -> None:
        if left == 0:
            found.append(terms)
        elif len(terms) < depth:
            for term in range(min(left, terms[-1] if terms else units - 1), 0, -1):
                if term * (depth - len(terms)) >= left:
                    extend([*terms, term], left - term)

    extend([], units)
    rows = np.zeros((len(found), units - 1))
    for row, terms in zip(rows, found, strict=True):
        np.add.at(row, np.array(terms) - 1, 1)
    return rows


def least_squares(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |matrix x - target|, by active sets."""
    x, active = np.zeros(matrix.shape[1]), np.zeros(matrix.shape[1], bool)
    close = 1e-9 * max(1.0, np.abs(target).max(initial=0)) * max(1.0, np.abs(matrix).max(initial=0)) * len(target)
    for _ in range(3 * len(target) + 10):
        gain = matrix.T @ (target - matrix @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= close:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            solved = np.linalg.lstsq(matrix[:, at], target, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[at] = solved
                break
            low = at[solved <= 0]
            step = np.min(x[low] / np.maximum(x[low] - solved[solved <= 0], 1e-300))
            x[at] += step * (solved - x[at])
            drop = low[x[low] <= 1e-12 * max(1.0, x.max(initial=0))]
            active[drop if len(drop) else low] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def plan(histogram: dict[int, int], window: int = WINDOW, grid: int = GRID, depth: int = DEPTH) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from_number, to_number, first_sequence, repeats, offset): numbers in this range lie in these sequences."""
    left = {length: count for length, count in histogram.items() if count}
    taken = dict.fromkeys(left, 0)
    ranges, sequence = [], 0

    def use(parts: list[tuple[int, int]], repeats: int) -> None:
        nonlocal sequence
        offset = 0
        for length, times in parts:
            first = taken[length]
            ranges.append((length, first, first + times * repeats, sequence, repeats, offset))
            taken[length] += times * repeats
            left[length] -= times * repeats
            offset += length * times
        sequence += repeats

    if left.get(window):
        use([(window, 1)], left[window])
    units = window // grid
    target = np.array([left.get(grid * (u + 1), 0) for u in range(units - 1)], float)
    if target.any():
        rows = combinations(units, depth)
        rows = rows[~(rows[:, target == 0] > 0).any(axis=1)]
        if len(rows):
            repeats = least_squares(rows.T, target)
            for i in np.argsort(-repeats, kind="stable"):
                parts = [(grid * (u + 1), int(rows[i, u])) for u in np.flatnonzero(rows[i])[::-1].tolist()]
                most = min(math.floor(repeats[i] + 1e-6), *(left[length] // times for length, times in parts))
                if most > 0:
                    use(parts, most)
    while any(left.values()):
        room, parts = window, []
        for length in sorted((k for k, n in left.items() if n), reverse=True):
            if times := min(left[length], room // length):
                parts.append((length, times))
                room -= times * length
        use(parts, min(left[length] // times for length, times in parts))
    return ranges


def pack(pieces: DataFrame, window: int = WINDOW, grid: int = GRID, depth: int = DEPTH, key: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to written pieces (they are read three times)."""
    spark = pieces.sparkSession
    histogram = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}
    ranges = plan(histogram, window, grid, depth)
    salts = max(8, math.ceil(max(histogram.values(), default=0) / SALT_ROWS))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(F.col(key), "start", "ids_crc32"), F.lit(salts)).cast("int"))
    before = (
        salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n"))
        .drop("_n")
    )
    alike = Window.partitionBy("length", "_salt").orderBy(key, "start", "ids_crc32", "doc_tokens")
    table = spark.createDataFrame(ranges, "_length long, _from long, _to long, _first long, _repeats long, _offset long")
    number = F.col("_before") + F.col("_own")
    within = F.col("_number") - F.col("_from")
    return (
        salted.withColumn("_own", F.row_number().over(alike) - 1)
        .join(before, ["length", "_salt"])
        .withColumn("_number", number)
        .join(F.broadcast(table), (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_to")))
        .withColumn("sequence_id", F.col("_first") + within % F.col("_repeats"))
        .withColumn("offset", F.col("_offset") + F.floor(within / F.col("_repeats")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    return pack(stage(token_pieces(docs, path, key, text, with_ids=with_ids), "pieces"), key=key)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens): the windows themselves, padded unless their length is a power of two; needs pieces with ids."""
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda piece: piece["ids"]))
    whole = packed.groupBy("sequence_id").agg(joined.alias("ids")).withColumn("n_tokens", F.size("ids"))
    power = F.expr("(n_tokens & (n_tokens - 1)) = 0")
    padding = F.array_repeat(F.lit(pad_id).cast("int"), F.lit(window) - F.col("n_tokens"))
    return whole.withColumn("ids", F.when(power, F.col("ids")).otherwise(F.concat("ids", padding)))
