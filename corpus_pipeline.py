"""From raw documents to packed training sequences: five stages, each one operator of `almanac.llm`.

Every stage but the last returns the columns of documents. `run` writes each result as Parquet
under the shared checkpoint folder and reads it again for the next stage, so a lost executor costs
the tasks it ran and no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from almanac.llm import mixing, near_dedup, packing, secret_scan, toxicity
from almanac.llm.common import remainder, table
from almanac.sources.files import remove_folder
from almanac.sources.stage import root_of, scratch, stage

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled examples do not call toxic."""
    index = toxicity.build_index(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return toxicity.without_toxic(docs, index)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in the place of secrets."""
    return secret_scan.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and their places in the training sequences; `packing.sequences` joins them."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix),
    ("packing", pack),
]

#: Learned and pseudorandom stages can't be said in SQL; tests hold `run` against the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. What a stage has written besides its result goes with it, and the result when the next one has it.

    Null or empty texts, repeated rows and an empty table go through all stages, each as its operator says.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, apply in STAGES[:-1]:
        with scratch(spark):
            docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}", to_stay=True)
        if before:
            remove_folder(spark, before)
        before = root_of(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
