"""Tokens per text by a two-tier look-up on the map side; no word is ever shuffled but those of a bounded sample.

Tier one is a compact table of frequent words and their token counts, encoded once and broadcast;
tier two the cache of each Python worker, where the words that tier one misses are encoded once.
Vocabularies that keep white space, and texts that hold a special string, are encoded whole.

Rows with null text count as empty; a repeated row gives a row each; an empty table gives
no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import SPACE, ship, slices, text_or_empty
from almanac.llm.encoding import CACHE_WORD_BYTES, Encoder, Lengths, worker_encoder

#: Rows, about, from which the table of frequent words is made; it only saves time, counts are exact without it.
SAMPLE_ROWS = 2_000
#: Words in the broadcast table, at most; under 4 MB.
TABLE_WORDS = 50_000


def frequent_words(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS, table_words: int = TABLE_WORDS) -> list[str]:
    """The most frequent words of a sample of rows, chosen by a hash of the text's first characters and length."""
    rows = docs.count()
    step = max(1, rows // max(1, sample_rows))
    chosen = F.pmod(F.xxhash64(F.substring(text, 1, 64), F.length(text)), F.lit(step)) == 0
    words = (
        docs.where(chosen)
        .select(F.explode(F.split(F.col(text).cast("string"), SPACE)).alias("word"))
        .where(F.octet_length("word").between(1, CACHE_WORD_BYTES))
        .groupBy("word").count()
        .orderBy(F.desc("count"), "word")
        .limit(table_words)
    )
    return [row.word for row in words.select("word").collect()]


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", **sizes: int) -> Lengths:
    """Tier one: the frequent words with the tokens of each; empty for a vocabulary whose tokens span white space."""
    encoder = Encoder(path)
    return encoder.table(frequent_words(docs, text, **sizes) if encoder.by_word else [])


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row."""
    spark = docs.sparkSession
    ship(spark)
    narrow = docs.select(F.col(key), text_or_empty(text).alias("text"))
    table = spark.sparkContext.broadcast(frequent_lengths(narrow, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for batch in slices(batches, "text"):
            texts = batch.column(1)
            counts = encoder.count(texts, table.value)
            yield pa.record_batch({
                key: batch.column(0),
                "n_bytes": pc.cast(pc.binary_length(texts), pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "over_limit": pa.array(np.asarray(counts) > limit),
            })

    kind = narrow.schema[key].dataType.simpleString()
    return narrow.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
