"""Written intermediate tables in the shared checkpoint folder.

A staged table cuts lineage (a lost executor re-reads files instead of re-running the
scan that made them), is the same for every consumer, and has a known size, so Spark's
own broadcast threshold decides with the true size whether it is broadcast in a join.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.clean import quoted
from almanac.sources.buckets import Buckets, open_buckets, write_buckets
from almanac.sources.files import exists, remove_folder

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def clustered(df: DataFrame, partition_by: Sequence[str] = (), sort_by: str | None = None) -> DataFrame:
    """Rows brought together by folder (adaptive execution splits large ones and merges small ones) and sorted within files."""
    rows = df.hint("rebalance", *map(F.col, partition_by)) if partition_by else df
    return rows.sortWithinPartitions(*partition_by, sort_by) if sort_by else rows


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session falls back to a temporary one."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="almanac-")
    return _local_roots[app]


def stage_folder(spark: SparkSession) -> str:
    """The folder of this application's staged tables."""
    return f"{checkpoint_root(spark)}/almanac/{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Remove all staged tables of this application; for when its results are written."""
    remove_folder(spark, stage_folder(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end, when nothing that reads them lazily is left."""
    folder = f"run-{uuid.uuid4().hex}"
    before = _inside.set(folder)
    try:
        yield
    finally:
        _inside.reset(before)
        remove_folder(spark, f"{stage_folder(spark)}/{folder}")


_inside: ContextVar[str] = ContextVar("inside", default="")


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None, sort_by: str | None = None, to_stay: bool = False) -> DataFrame:
    """Write the rows once and return the written table; `to_stay`: not with the tables of a `scratch`."""
    path = _new_path(df.sparkSession, name, to_stay)
    writer = clustered(df, partition_by or [], sort_by).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*map(quoted, df.columns))


def stage_in_buckets(df: DataFrame, name: str, buckets: Buckets) -> DataFrame:
    """Write the rows once, in buckets: what reads them by those columns again and again shuffles them no more."""
    path = _new_path(df.sparkSession, name)
    write_buckets(df, path, buckets)
    return open_buckets(df.sparkSession, path, df.schema, buckets)


def _new_path(spark: SparkSession, name: str, to_stay: bool = False) -> str:
    inside = "" if to_stay else _inside.get()
    return "/".join([stage_folder(spark), *([inside] if inside else []), f"{name}-{uuid.uuid4().hex}"])


def root_of(staged: DataFrame, partition_by: Sequence[str] = ()) -> str | None:
    """The folder of a staged table that is partitioned so; None when it has no rows."""
    files = staged._jdf.inputFiles()
    return unquote(files[0].rsplit("/", len(partition_by) + 1)[0]) if len(files) else None


def still_there(staged: DataFrame) -> bool:
    """Whether the files of a staged table exist, for callers that keep one across queries."""
    files = staged.inputFiles()
    return bool(files) and exists(staged.sparkSession, files[0])
