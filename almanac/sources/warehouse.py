"""Tables of the warehouse: <root>/<layer>/<table>/<version> as Parquet, also named <layer>.<table> for SQL."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.operators.quality import ColumnTest, watched
from almanac.sources.buckets import Buckets, create_named, open_buckets, write_buckets
from almanac.sources.commits import Commits
from almanac.sources.files import has_files, path_of, qualified, remove_folder, subfolders, time_of
from almanac.sources.stage import clustered

LAYERS = ("bronze", "silver", "gold")
#: Replaced versions stay so long for the readers that have begun with them.
KEEP_HOURS = 24.0
#: Tables written at the same time by one call.
AT_ONCE = 8
_VERSION = re.compile(r"v-[0-9a-f]{32}")


def _as_read(schema: T.StructType) -> str:
    """The schema as written files give it back: anything may be null."""
    return re.sub(r'("(?:nullable|containsNull|valueContainsNull)"): ?false', r"\1:true", schema.json())


def _in_buckets(state: dict) -> tuple[T.StructType, Buckets]:
    """Schema and buckets of a committed version."""
    held = state["buckets"]
    return T.StructType.fromJson(json.loads(state["schema"])), Buckets(tuple(held["columns"]), held["number"], tuple(held["sort_by"]))


def _no_glob(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, keep_hours: float = KEEP_HOURS):
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            raise ValueError(f"the tables are in UTC: set spark.sql.session.timeZone to UTC, it is {zone}")
        self.spark, self.root, self.keep_hours = spark, qualified(spark, root), keep_hours
        for layer in LAYERS:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")

    def _commits(self, layer: str, table: str) -> Commits:
        return Commits(self.spark, f"{self.root}/{layer}/{table}/_commits")

    def path(self, layer: str, table: str) -> str:
        """Where the table's files are now: its committed version, or the folder itself."""
        folder, version = f"{self.root}/{layer}/{table}", self._commits(layer, table).head().get("version")
        return f"{folder}/{version}" if version else folder

    def write(self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: str | None = None,
              tests: Sequence[ColumnTest] = (), buckets: Buckets | None = None) -> None:
        """Replace the table with the rows of `df`, in folders by `partition_by` or in `buckets`.

        Rows that fail one of the `tests` are counted as they are written; the commit keeps the counts.

        They are written to a new version, which one commit then makes the table. Readers that have begun
        go on with the version before; it is removed `keep_hours` after it was replaced. Rows are brought
        together by folder, so that a folder has few files, whatever the number of tasks.
        """
        if buckets and (partition_by or sort_by):
            raise ValueError("folders or buckets; the order of rows within buckets is part of the buckets")
        version = f"v-{uuid.uuid4().hex}"
        rows, failed = watched(df, tests)
        path = f"{self.root}/{layer}/{table}/{version}"
        if buckets:
            write_buckets(rows, path, buckets)
        else:
            clustered(rows, partition_by, sort_by).write.partitionBy(*partition_by).parquet(path)
        state = {"version": version, "schema": _as_read(df.schema)}
        state["tests"] = [[t.column, t.test, list(t.values), n] for t, n in failed().items()]
        if buckets:
            state["buckets"] = asdict(buckets)
        self._commits(layer, table).commit(lambda _: state)
        self._name(layer, table, None if partition_by else T.StructType.fromJson(json.loads(_as_read(df.schema))))
        self.clean(layer, table)

    def write_all(self, layer: str, tables: Mapping[str, DataFrame], at_once: int = AT_ONCE) -> None:
        """Replace several tables, a few at a time; the first failure is raised when those under way have ended."""
        with ThreadPoolExecutor(at_once) as pool:
            for done in [pool.submit(self.write, layer, name, df) for name, df in tables.items()]:
                done.result()

    def by_schema(self, layer: str, prefix: str = "") -> list[tuple[T.StructType, list[str]]]:
        """(schema, paths) of the tables whose name starts with exactly this prefix, one entry for each different schema.

        Tasks read the tables' commits, in one job for any number of tables. A table that was not written here
        has none; its own files are asked, one table after another.
        """
        names = self.tables(layer, prefix)
        if not names:
            return []
        found = self._committed(layer, prefix)
        alike: dict[str, list[str]] = {}
        for schema, paths in found:
            alike.setdefault(schema, []).extend(paths)
        known = {path.rsplit("/", 2)[-2] for _, paths in found for path in paths}
        for name in names:
            if name not in known and has_files(self.spark, f"{self.root}/{layer}/{name}"):
                path = f"{self.root}/{layer}/{name}"
                alike.setdefault(self.spark.read.parquet(path).schema.json(), []).append(path)
        return [(T.StructType.fromJson(json.loads(schema)), sorted(paths)) for schema, paths in sorted(alike.items())]

    def _committed(self, layer: str, prefix: str) -> list[tuple[str, list[str]]]:
        folder = f"{self.root}/{layer}"
        glob = f"{_no_glob(f'{folder}/{prefix}')}*/_commits/*.json"
        try:
            lines = self.spark.read.option("wholetext", True).text(glob)
        except AnalysisException as fault:
            if fault.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        place = path_of(F.col("_metadata.file_path"))
        state = F.from_json("value", "version string, schema string")
        commits = lines.select(F.regexp_extract(place, r"/([^/]+)/_commits/(\d+)\.json$", 1).alias("table"),
                               F.regexp_extract(place, r"/(\d+)\.json$", 1).alias("number"), state.alias("state")).where("state.schema IS NOT NULL")
        newest = commits.groupBy("table").agg(F.max_by("state", "number").alias("state"))
        path = F.concat(F.lit(f"{folder}/"), "table", F.lit("/"), "state.version")
        grouped = newest.groupBy("state.schema").agg(F.collect_list(path).alias("paths"))
        return [(row.schema, row.paths) for row in grouped.collect()]  # as many paths as a reader of these tables names

    def clean(self, layer: str, table: str) -> None:
        """Remove versions out of use, those of runs that died included."""
        commits, folder = self._commits(layer, table), f"{self.root}/{layer}/{table}"
        states, limit = commits.in_use(self.keep_hours * 3600)
        used = {state["version"] for state in states}
        for name in subfolders(self.spark, folder):
            if _VERSION.fullmatch(name) and name not in used and time_of(self.spark, f"{folder}/{name}") < limit:
                remove_folder(self.spark, f"{folder}/{name}")
        commits.forget(self.keep_hours * 3600)

    def failed(self, layer: str, table: str) -> dict[ColumnTest, int]:
        """Rows of the table that failed a test, as counted when it was written."""
        return {ColumnTest(c, t, tuple(v)): n for c, t, v, n in self._commits(layer, table).head().get("tests", [])}

    def read(self, layer: str, table: str) -> DataFrame:
        state = self._commits(layer, table).head()
        if "buckets" in state:
            return open_buckets(self.spark, f"{self.root}/{layer}/{table}/{state['version']}", *_in_buckets(state))
        return self.spark.read.parquet(self.path(layer, table))

    def tables(self, layer: str, prefix: str = "") -> list[str]:
        """Tables of a layer whose name starts with exactly this prefix."""
        return [t for t in subfolders(self.spark, f"{self.root}/{layer}") if t.startswith(prefix)]

    def attach(self) -> None:
        """Name the silver and gold tables that earlier sessions built, so that SQL finds them."""
        for layer in ("silver", "gold"):
            for table in self.tables(layer):
                self._name(layer, table)

    def _name(self, layer: str, table: str, schema: T.StructType | None = None) -> None:
        # the catalog takes letters, digits and underscores only
        name, catalog = f"{layer}.`{re.sub(r'[^A-Za-z0-9_]', '_', table)}`", self.spark.catalog
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the name only; files stay
        state = self._commits(layer, table).head()
        if "buckets" in state:
            create_named(self.spark, name, f"{self.root}/{layer}/{table}/{state['version']}", *_in_buckets(state))
            return
        catalog.createTable(name, path=self.path(layer, table), source="parquet", schema=schema)
        if schema is None and any(column.isPartition for column in catalog.listColumns(name)):
            catalog.recoverPartitions(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 16,
) -> DataFrame:
    """A database table; with `split_on`, a whole-number column, it is read by `splits` tasks over ranges of it.

    Without `bounds` the column's smallest and largest values are asked for first.
    """
    if split_on is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        ask = f"(SELECT MIN({split_on}) AS low, MAX({split_on}) AS high FROM {table}) bounds"
        found = spark.read.jdbc(url, ask, properties=properties).first()
        bounds = (found[0] or 0, found[1] or 0)
    low, high = bounds
    if low >= high:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, split_on, low, high, splits, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Replace a database table."""
    df.write.mode("overwrite").jdbc(url, table, properties=properties)
