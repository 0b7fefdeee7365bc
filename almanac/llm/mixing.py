"""Mixing sources to target weights by blocks, multinomial shard counts and index permutations.

1. Each source's texts, in a fixed pseudorandom order, are one stream of words cut into blocks of
   `block_words`. A text's place in the stream is a sum of sizes, made per (source, salt) with as
   many salts as the largest source needs.
2. The mix has as many block slots as the targets need, dealt evenly to output shards. For each shard in
   turn a multinomial draw says how many of its slots each source gets, with what the sources' targets still
   lack as weights; these draws decide what is taken. What a draw gives a source beyond its target's last
   slot, or beyond `most` rounds of its blocks, is drawn again among the others, so totals come close to the targets.
3. Slot j of a source, counted over the shards, takes block permutation(j mod blocks) of round j div blocks; the permutation
   is a keyed four-round Feistel network on the block index, different for each source and round.
4. Slots are joined with the blocks by index; what a text gives to the mix is the words of its
   blocks times how often they were drawn.

Targets share all words by weight. A target above `most` times its source stops there and the
excess is shared again, so no block is drawn more than `most` times. Draws depend on the seed and on
the sources' names and sizes alone: reruns agree. The driver holds a number for each source and shard.

Null text has size 0 and takes nothing; null is a source of its own, last in order. Repeated rows
are rows of their own. Ties in the order of texts are broken by size; rows that agree in id, source
and size are interchangeable. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import SPACE, WORD, ship
from almanac.sources.stage import stage

BLOCK_WORDS, MOST_ROUNDS, SEED = 64, 3, 20
#: Weights of the sources in order of name, repeated as often as needed.
WEIGHTS = (5.0, 2.0, 1.0)
#: Rows of one source whose sizes one task sums up, about.
SALT_ROWS = 100_000
#: Slots of a shard, about; slots that one row stands for before they are listed.
SHARD_SLOTS, CHUNK_SLOTS = 1 << 20, 1 << 16


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float
    blocks: int
    slots: float  # that the target needs


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, most: float = MOST_ROUNDS) -> dict[str | None, float]:
    """Words per source: all words by weight; sources by code point, null last."""
    order = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(order)}
    left, free, fixed = float(sum(sizes.values())), set(order), {}
    while free:
        whole = sum(weight[name] for name in order if name in free)
        share = {name: left * weight[name] / whole for name in order if name in free}
        above = [name for name in share if share[name] > most * sizes[name]]
        if not above:
            return {name: fixed.get(name, share.get(name)) for name in order}
        for name in above:
            fixed[name] = float(most * sizes[name])
            free.discard(name)
            left -= fixed[name]
    return {name: fixed[name] for name in order}


def _source(name: str | None, size: int, target: float, block_words: int, most: int) -> Source:
    blocks = -(-size // block_words)
    rounds = min(most, math.floor(target / size)) if size else 0
    rest = min(blocks, (target - rounds * size) / block_words) if rounds < most else 0
    return Source(name, size, target, blocks, rounds * blocks + rest)


def shard_counts(sources: Sequence[Source], shards: int, most: int = MOST_ROUNDS, seed: int = SEED) -> np.ndarray:
    """Shards x sources: how many slots of each shard each source gets."""
    pick = np.random.default_rng([seed, *(_key(s.name, s.blocks, seed) for s in sources)])
    lacks, room = np.array([s.slots for s in sources], float), np.array([most * s.blocks for s in sources], np.int64)
    total = round(lacks.sum())
    counts = np.zeros((shards, len(sources)), np.int64)
    for shard in range(shards):
        left = total * (shard + 1) // shards - total * shard // shards
        while left > 0:
            weight, bound = np.where(room > 0, np.maximum(lacks, 0), 0), np.minimum(room, np.ceil(np.maximum(lacks, 0)).astype(np.int64))
            if not weight.sum() > 0:
                weight, bound = room.astype(float), room
            if not weight.sum() > 0:
                break  # every block is drawn `most` times
            drawn = np.minimum(pick.multinomial(left, weight / weight.sum()), bound)
            counts[shard] += drawn
            lacks, room, left = lacks - drawn, room - drawn, left - int(drawn.sum())
    return counts


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. n - 1, at the given indexes."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out, walk = index.astype(np.uint64), np.arange(len(index))
    while len(walk):
        left, right = out[walk] >> np.uint64(half), out[walk] & low
        for turn in range(4):
            with np.errstate(over="ignore"):
                mixed = (right + np.uint64((key * 4 + turn) & 0xFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & low)
        out[walk] = (left << np.uint64(half)) | right
        walk = walk[out[walk] >= n]
    return out.astype(np.int64)


def _key(name: str | None, round_: int, seed: int) -> int:
    return zlib.crc32(f"{seed}|{'' if name is None else 's' + name}|{round_}".encode())


def _slots(spark, sources: list[Source], most: int, seed: int) -> DataFrame:
    """(place, block, shard, slot), a row for each slot; place is the source's number, slot its number in the source."""
    shards = max(64, math.ceil(sum(s.slots for s in sources) / SHARD_SLOTS))
    counts = shard_counts(sources, shards, most, seed)
    rows, first = [], np.zeros(len(sources), np.int64)
    for shard in range(shards):
        for i in np.flatnonzero(counts[shard]).tolist():
            past = int(first[i] + counts[shard, i])
            rows += [(i, sources[i].name, sources[i].blocks, shard, a, min(a + CHUNK_SLOTS, past)) for a in range(int(first[i]), past, CHUNK_SLOTS)]
            first[i] = past

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                slot = np.arange(row["first"], row["past"])
                rounds, index = slot // row["blocks"], slot % row["blocks"]
                block = np.empty(len(slot), np.int64)
                for round_ in np.unique(rounds).tolist():
                    own = rounds == round_
                    block[own] = permuted(index[own], row["blocks"], _key(row["name"], round_, seed))
                yield pa.record_batch({"place": pa.array(np.full(len(slot), row["place"], np.int32)), "block": pa.array(block),
                                       "shard": pa.array(np.full(len(slot), row["shard"], np.int32)), "slot": pa.array(slot)})

    drawn = spark.createDataFrame(rows, "place int, name string, blocks long, shard int, first long, past long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return drawn.repartition(tasks).mapInArrow(take, "place int, block long, shard int, slot long")


def _sizes(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Mix:
    """sources in order; placed: rows with their place in the stream; pieces: their blocks with `times`; slots: the drawn blocks."""

    sources: list[Source]
    placed: DataFrame
    pieces: DataFrame
    slots: DataFrame


def plan_mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS,
             block_words: int = BLOCK_WORDS, most: int = MOST_ROUNDS, seed: int = SEED) -> Mix:
    spark = docs.sparkSession
    ship(spark)
    sized = stage(docs.select(F.col(key).alias("_id"), F.col(source).cast("string").alias("_source"), _sizes(text).alias("size"),
                              F.xxhash64(F.col(text)).alias("_hash")), "sized")
    totals = sized.groupBy("_source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
    sizes = {row._source: row.size for row in totals}
    aims = targets(sizes, weights, most)
    sources = [_source(name, sizes[name], aim, block_words, most) for name, aim in aims.items()]
    table = spark.createDataFrame([(i, s.name, s.size, float(s.target)) for i, s in enumerate(sources)],
                                  "place int, _name string, source_size long, target double")
    salts = max(8, math.ceil(max((row.rows for row in totals), default=0) / SALT_ROWS))
    salted = (
        sized.join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("_name")))
        .withColumn("_salt", F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(salts)).cast("int"))
    )
    before = (
        salted.groupBy("place", "_salt").agg(F.sum("size").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("place").orderBy("_salt")) - F.col("_n")).drop("_n")
    )
    alike = Window.partitionBy("place", "_salt").orderBy("_id", "size", "_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        salted.withColumn("_own", F.sum("size").over(alike) - F.col("size"))
        .join(before, ["place", "_salt"])
        .select("_id", "_source", "_hash", "place", "size", "source_size", "target", (F.col("_before") + F.col("_own")).alias("start"))
    )
    slots = _slots(spark, sources, most, seed)
    times = slots.groupBy("place", "block").agg(F.count("*").alias("times"))
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    from_ = F.greatest(F.col("start"), F.col("block") * block_words)
    to = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = (
        placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
        .join(times.hint("merge"), ["place", "block"], "left")  # blocks grow with the input
        .withColumn("times", F.coalesce("times", F.lit(0)))
        .withColumn("word", from_ - F.col("start")).withColumn("words", to - from_)
    )
    return Mix(sources, placed, pieces, slots)


def drawn_blocks(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **settings) -> DataFrame:
    """(key, source, shard, slot, block, word, words): what each slot of the mix takes: `words` words of a text from its word number `word` on."""
    made = plan_mix(docs, key, source, text, **settings)
    taken = made.pieces.drop("times").join(made.slots.hint("merge"), ["place", "block"])
    return taken.select(F.col("_id").alias(key), F.col("_source").alias(source), "shard", "slot", "block", "word", "words")


def mix(docs: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """(key, size, source_size, target, taken) for every row."""
    made = plan_mix(docs, key, **settings)
    row = ["_id", "place", "start", "size", "source_size", "target"]
    taken = made.pieces.groupBy(*row).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    empty = made.placed.where("size = 0").select(*row, F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(empty).select(F.col("_id").alias(key), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **settings) -> DataFrame:
    """The mix itself, with the columns of `docs`: a row for each time a text, or a part of it, is drawn.

    The n-th row of a text has the words of all its blocks that were drawn n times or more, with the
    white space between them; `n_chars`, where there is such a column, follows the text.
    """
    made = plan_mix(docs, key, source, text, **settings)
    same = ["_id", "_source", "_hash"]
    number = Window.partitionBy(*same).orderBy("start")
    drawn = (
        made.pieces.groupBy(*same, "place", "start")
        .agg(F.array_sort(F.collect_list(F.struct("word", "words", "times"))).alias("_parts"))
        .withColumn("_copy", F.row_number().over(number))
    )
    ids = [F.col(key).alias("_id"), F.col(source).cast("string").alias("_source"), F.xxhash64(F.col(text)).alias("_hash")]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *ids).where(F.col(f"_doc.`{text}`").isNotNull())
    numbered = whole.withColumn("_copy", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(1))))
    equal = [numbered[c].eqNullSafe(drawn[c]) for c in same]
    joined = numbered.join(drawn, [*equal, numbered["_copy"] == drawn["_copy"]]).select("_doc", "_parts", F.col(f"_doc.`{text}`").alias("_text"))
    uneven = F.array_min("_parts.times") != F.array_max("_parts.times")
    token = f"{SPACE[:-1]}*{WORD}{SPACE[:-1]}*"
    cut = (
        joined.withColumn("_tokens", F.when(uneven, F.regexp_extract_all("_text", F.lit(token), 0)))
        .withColumn("_copies", F.array_max("_parts.times").cast("int")).where("_copies > 0")
        .withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .withColumn("_kept", F.expr("filter(_parts, part -> part.times >= _nth)"))
        .withColumn("_cut", F.when(F.size("_kept") == F.size("_parts"), F.col("_text")).otherwise(
            F.expr("array_join(flatten(transform(_kept, part -> slice(_tokens, CAST(part.word AS INT) + 1, CAST(part.words AS INT)))), '')")))
    )
    fresh = {text: F.col("_cut")} | ({"n_chars": F.when(F.col("_cut") == F.col("_text"), F.col("_doc.n_chars")).otherwise(F.length("_cut"))}
                                     if "n_chars" in docs.columns else {})
    return cut.select(*[fresh.get(c, F.col(f"_doc.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
