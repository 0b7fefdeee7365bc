"""Latest-snapshot operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.sources.stage import stage


def latest_per_key(df: DataFrame, key: str, date: str) -> DataFrame:
    """All rows on the latest date of their key; rows without key or date are dropped.

    The latest dates are staged: Spark then knows their true size and broadcasts them
    while they are below its threshold, so the rows themselves are filtered where they
    are read. Beyond it the join shuffles both sides and splits skewed keys.
    """
    latest = stage(df.groupBy(key).agg(F.max(date).alias(date)), "latest")
    return df.join(latest, [key, date])


def latest_overall(df: DataFrame, date: str) -> DataFrame:
    """All rows on the latest date of the whole table."""
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def stored_maximum(spark: SparkSession, path: str, column: str):
    """The largest value of a date or number column of a Parquet table, from the statistics in its files' footers.

    No row group is read: Spark pushes the aggregate to the files where it reads them by its newer reader,
    which a session of its own is told to use. None for a table without values.
    """
    return _maximum(spark, path, column).first()[0]


def _maximum(spark: SparkSession, path: str, column: str) -> DataFrame:
    own = spark.newSession()
    for name, value in _FOOTERS.items():
        own.conf.set(name, value)
    return own.read.parquet(path).agg(F.max(column))


_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def rows_of_top_keys(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """All rows whose key is among the n keys with the largest `value`."""
    top = (
        df.groupBy(key)
        .agg(F.max(value).alias("_top"))
        .orderBy(F.col("_top").desc_nulls_first(), F.col(key).asc_nulls_last())
        .limit(n)
        .select(key)
    )
    return df.join(F.broadcast(top), key)  # n rows
