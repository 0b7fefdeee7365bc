"""Ingest of report files as they arrive: the batch load, run on the files not seen before."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from almanac.sources.bronze import Bronze
from almanac.sources.reports import changed_files, ingest_files, report_empty_files
from almanac.sources.stage import stage

_FILE = "path string, modificationTime timestamp, length bigint, content binary"
#: Files of one micro-batch, at most; more files are more batches.
BATCH_FILES = 10_000


def ingest_new_reports(
    spark: SparkSession, landing: str, feed: str, bronze: str, state: str,
    aliases: Mapping[str, str] | None = None, batch_files: int = BATCH_FILES,
) -> StreamingQuery:
    """Load the files that earlier runs with the same `state` folder have not loaded, and those that have changed since.

    Only names flow through the stream; contents are read by the batch load, which replaces whole files, so a
    repeated micro-batch changes nothing. What is left out is kept as by the batch load, one set for each
    micro-batch. The stream tells files apart by name: one that was replaced under its name is found
    at the start of a run, by its time and length, which bronze keeps of every file. Empty files, of which no
    stream tells, are listed then too.
    """
    known = Bronze(spark, bronze, feed)
    if known.loaded():
        replaced = stage(changed_files(spark, landing, feed, bronze), "replaced")
        if not replaced.isEmpty():
            ingest_files(replaced, feed, bronze, aliases)
    report_empty_files(spark, landing, feed, bronze)
    files = (
        spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", batch_files).load(f"{landing}/{feed}")
        .select("path", F.unix_millis("modificationTime").alias("time"), "length")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        ingest_files(batch, feed, bronze, aliases, f"batch {batch_id}")

    return (
        files.writeStream.foreachBatch(load).option("checkpointLocation", f"{state}/{feed}")
        .trigger(availableNow=True).start()
    )
