"""Tables in buckets: rows with equal values of some columns lie in files of one bucket.

Windows, groups and joins on those columns, or on more than those, read such a table without a shuffle; Spark
reads it in even splits where a query has no use for the buckets. Rows are brought together by bucket before they
are written; adaptive execution cuts a bucket that is far larger than others into several files, so that no task
writes a frequent value alone. Reading it in one piece stays one task, as for a shuffle: cut such a value by the
operator (`operators.series` does).

Spark keeps the buckets of a table in its catalog only. A table is named there while it is written or opened;
the opened rows go on without the name, so nothing is left in a catalog that outlives the session.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.clean import quoted


@dataclass(frozen=True)
class Buckets:
    """`number` buckets by `columns`; rows within a file are in the order of `sort_by`."""

    columns: tuple[str, ...]
    number: int
    sort_by: tuple[str, ...] = ()

    def clause(self) -> str:
        ordered = f" SORTED BY ({', '.join(map(quoted, self.sort_by))})" if self.sort_by else ""
        return f"CLUSTERED BY ({', '.join(map(quoted, self.columns))}){ordered} INTO {self.number} BUCKETS"


def buckets_by(spark: SparkSession, *columns: str, sort_by: tuple[str, ...] = ()) -> Buckets:
    """As many buckets as a shuffle of this session has partitions: a bucket is read by one task, as a partition is."""
    return Buckets(columns, int(spark.conf.get("spark.sql.shuffle.partitions")), sort_by)


def write_buckets(rows: DataFrame, path: str, buckets: Buckets) -> None:
    """Write a new table to a folder that does not exist."""
    number = F.pmod(F.hash(*map(quoted, buckets.columns)), F.lit(buckets.number))  # the bucket that Spark puts a row in
    together = rows.withColumn("_bucket", number).hint("rebalance", F.col("_bucket")).drop("_bucket")
    writer = together.write.format("parquet").mode("errorifexists").bucketBy(buckets.number, *buckets.columns)
    if buckets.sort_by:
        writer = writer.sortBy(*buckets.sort_by)
    name = _new_name()
    try:
        writer.option("path", path).saveAsTable(name)
    finally:
        _forget(rows.sparkSession, name)


def open_buckets(spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets) -> DataFrame:
    """The rows of a written table, with its buckets."""
    name = _new_name()
    try:
        create_named(spark, name, path, schema, buckets)
        return spark.table(name).select(*map(quoted, schema.names))
    finally:
        _forget(spark, name)


def create_named(spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: Buckets) -> None:
    """A catalog name, which stays, for a written table."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {buckets.clause()} LOCATION '{place}'")


def _new_name() -> str:
    return f"default.bucketed_{uuid.uuid4().hex}"


def _forget(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the name only; files stay
