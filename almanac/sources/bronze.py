"""The bronze dataset of a feed: what loads have brought, file by file, switched in one step for each load.

Every load writes its rows to a folder of its own, `<bronze>/<feed>/load=<id>`, by file date and source
table, and what it left out to `<bronze>/_faults/<feed>/load=<id>`. Then it writes the new list of
contents, a small table with a row for each source table and set of faults and the load that has it
and for each file that was seen with its time and length, and commits it. So a load replaces exactly the files it accepted, those without rows included, at once or
not at all; readers of the list before go on with the folders they know.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.clean import quoted
from almanac.sources.commits import Commits
from almanac.sources.feeds import FEEDS, SOURCE
from almanac.sources.files import remove_folder, subfolders, time_of
from almanac.sources.stage import clustered

FILE_DATE, TABLE, LOAD = "file_date", "source_table", "load"
# left_out: file, row or cell. A cell left out is empty in the cleaned tables; its row is loaded.
FAULTS = "feed string, file string, left_out string, reason string, column string, cell string, line string"
#: `label` names a set of faults; a later load with the same label replaces it. `current` is false for replaced rows.
_CONTENTS = "kind string, load string, label string, file_date date, source_table string, current boolean, time long, length long"


def source_table(feed: str, file: Column) -> Column:
    """us + 04-12-2020.csv -> us_04_12_2020"""
    stem = F.regexp_replace(file, r"\.csv$", "")
    return F.concat(F.lit(f"{feed}_"), F.replace(stem, F.lit("-"), F.lit("_")))


def file_date(file: Column) -> Column:
    """The date in the file name, NULL when it has none."""
    written = F.regexp_extract(file, r"^(\d{2}-\d{2}-\d{4})\.csv$", 1)
    return F.try_to_timestamp(written, F.lit("MM-dd-yyyy")).cast("date")


@dataclass(frozen=True)
class Bronze:
    spark: SparkSession
    root: str
    feed: str

    @property
    def rows_at(self) -> str:
        return f"{self.root}/{self.feed}"

    @property
    def faults_at(self) -> str:
        return f"{self.root}/_faults/{self.feed}"

    @property
    def _lists_at(self) -> str:
        return f"{self.root}/_contents/{self.feed}"

    @property
    def commits(self) -> Commits:
        return Commits(self.spark, f"{self.root}/_commits/{self.feed}")

    def loaded(self) -> bool:
        """Whether any load has been committed."""
        return bool(self.commits.head())

    def columns(self) -> list[str] | None:
        """Columns that any loaded file has had; None when rows were brought that are of no file."""
        return self.commits.head().get("columns")

    def load(
        self, rows: DataFrame | None = None, files: DataFrame | None = None, columns: Iterable[str] | None = None,
        faults: DataFrame | None = None, label: str | None = None, seen: DataFrame | None = None,
    ) -> str:
        """One load: `rows` (with `_file`) take the place of all that earlier loads have of `files` (`_file`; those of the rows by default).

        `seen`: (file, time, length) of all files that the load looked at.
        """
        load = uuid.uuid4().hex
        if rows is not None:
            named = rows.withColumns({FILE_DATE: file_date(F.col("_file")), TABLE: source_table(self.feed, F.col("_file"))}).drop("_file")
            clustered(named, [FILE_DATE, TABLE]).write.partitionBy(FILE_DATE, TABLE).parquet(f"{self.rows_at}/{LOAD}={load}")
            written = self._written(load)
            replaced = written.select(TABLE) if files is None else files.select(source_table(self.feed, F.col("_file")).alias(TABLE))
        else:
            written = replaced = None
        if faults is not None:
            faults.write.parquet(f"{self.faults_at}/{LOAD}={load}")

        def change(state: dict) -> dict:
            listed = self._listed(state)
            if replaced is not None:
                old = replaced.distinct().select(F.col(TABLE).alias("_table"))
                listed = listed.join(old, F.col(TABLE) == F.col("_table"), "left").withColumn("current", F.col("current") & F.col("_table").isNull()).drop("_table")
                listed = listed.unionByName(written.select(F.lit("rows").alias("kind"), F.lit(load).alias(LOAD), F.lit(None).cast("string").alias("label"),
                                                           FILE_DATE, TABLE, F.lit(True).alias("current"), F.lit(None).cast("long").alias("time"), F.lit(None).cast("long").alias("length")))
            if faults is not None:
                again = (F.col("kind") == "faults") & (F.col("label") == (label or load))
                own = self.spark.createDataFrame([("faults", load, label or load, None, None, True, None, None)], _CONTENTS)
                listed = listed.withColumn("current", F.col("current") & ~again).unionByName(own)
            if seen is not None:
                here = seen.select(F.lit("file").alias("kind"), F.lit(load).alias(LOAD), F.col("file").alias("label"), F.lit(None).cast("date").alias(FILE_DATE),
                                   F.lit(None).cast("string").alias(TABLE), F.lit(True).alias("current"), "time", "length")
                again = here.select(F.lit("file").alias("_kind"), F.col("label").alias("_label"))
                same = (F.col("kind") == F.col("_kind")) & (F.col("label") == F.col("_label"))
                listed = listed.join(again, same, "left_anti").unionByName(here)
            had = state.get("columns") if state else []
            known = None if had is None or (rows is not None and columns is None) else sorted({*had, *(columns or ())})
            return {"contents": self._write_list(listed), "columns": known}

        self.commits.commit(change)
        return load

    def _written(self, load: str) -> DataFrame:
        """(file_date, source_table) of a load's rows, from its folders alone."""
        return self.spark.read.schema(f"{FILE_DATE} date, {TABLE} string").parquet(f"{self.rows_at}/{LOAD}={load}").distinct()

    def _listed(self, state: dict) -> DataFrame:
        if not state:
            return self.spark.createDataFrame([], _CONTENTS)
        return self.spark.read.schema(_CONTENTS).parquet(f"{self._lists_at}/{state['contents']}")

    def _write_list(self, listed: DataFrame) -> str:
        name = f"c-{uuid.uuid4().hex}"
        listed.hint("rebalance").write.parquet(f"{self._lists_at}/{name}")
        return name

    def read(self, columns: Iterable[str] | None = None) -> DataFrame:
        """Rows as text cells plus lineage: `columns`, or those columns of the cleaned table that a file has had.

        Only folders of listed loads are read. Rows of replaced files in them are left out by a join with
        the list of what was replaced, which is empty but after reloads.
        """
        state = self.commits.head()
        if not state:
            raise FileNotFoundError(f"feed {self.feed!r} has no rows under {self.root}")
        if columns is None:
            columns = [n for n in FEEDS[self.feed] if state["columns"] is None or n in state["columns"]]
        names = [*columns]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, LOAD, TABLE]]).add(FILE_DATE, T.DateType())
        listed = self._listed(state).where("kind = 'rows'")
        loads = listed.groupBy(LOAD).agg(F.count_if("current").alias("used"), F.count_if(~F.col("current")).alias("replaced")).where("used > 0").collect()
        if not loads:
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).option("basePath", self.rows_at).parquet(*[f"{self.rows_at}/{LOAD}={r[LOAD]}" for r in loads])
        if any(r.replaced for r in loads):
            old = listed.where("NOT current").select(F.col(LOAD).alias("_load"), F.col(TABLE).alias("_table"))
            rows = rows.join(old, (F.col(LOAD) == F.col("_load")) & (F.col(TABLE) == F.col("_table")), "left_anti")
        return rows.select(*map(quoted, names), FILE_DATE, F.concat(F.lit("bronze."), F.col(TABLE)).alias(SOURCE))

    def files(self) -> DataFrame:
        """(file, time, length) of the files that loads have looked at, as they were at the last look."""
        return self._listed(self.commits.head()).where("kind = 'file'").select(F.col("label").alias("file"), "time", "length")

    def faults(self) -> DataFrame:
        """What all loads left out."""
        listed = self._listed(self.commits.head()).where("kind = 'faults' AND current")
        loads = [r[LOAD] for r in listed.select(LOAD).collect()]
        schema = f"{FAULTS}, {LOAD} string"
        if not loads:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.faults_at).parquet(*[f"{self.faults_at}/{LOAD}={load}" for load in loads])

    def faults_of(self, load: str) -> DataFrame:
        """What one load left out."""
        return self.spark.read.schema(FAULTS).parquet(f"{self.faults_at}/{LOAD}={load}")

    def clean(self, keep_hours: float) -> None:
        """Remove what no reader of the last `keep_hours` can hold: replaced files, loads that died, old lists."""
        states, limit = self.commits.in_use(keep_hours * 3600)
        if not states:
            return
        gone = self._listed(states[0]).where("NOT current AND kind = 'rows'").select(LOAD, FILE_DATE, TABLE).collect()  # replaced and not yet removed
        for r in gone:
            day = r[FILE_DATE] or "__HIVE_DEFAULT_PARTITION__"
            remove_folder(self.spark, f"{self.rows_at}/{LOAD}={r[LOAD]}/{FILE_DATE}={day}/{TABLE}={r[TABLE]}")
        if gone:
            removed = self.spark.createDataFrame([(r[LOAD], r[TABLE]) for r in gone], "_load string, _table string")
            self.commits.commit(lambda state: state | {"contents": self._write_list(self._listed(state).join(
                removed, (F.col(LOAD) == F.col("_load")) & (F.col(TABLE) == F.col("_table")), "left_anti"))})
        states, _ = self.commits.in_use(keep_hours * 3600)
        used = {(r.kind, r[LOAD]) for state in states for r in self._listed(state).where("kind = 'rows' OR kind = 'faults' AND current").select("kind", LOAD).distinct().collect()}
        for kind, at in (("rows", self.rows_at), ("faults", self.faults_at)):
            for name in subfolders(self.spark, at):
                if name.startswith(f"{LOAD}=") and (kind, name.removeprefix(f"{LOAD}=")) not in used:
                    self._remove_before(f"{at}/{name}", limit)
        for name in subfolders(self.spark, self._lists_at):
            if name not in {state["contents"] for state in states}:
                self._remove_before(f"{self._lists_at}/{name}", limit)
        self.commits.forget(keep_hours * 3600)

    def _remove_before(self, path: str, limit: float) -> None:
        if time_of(self.spark, path) < limit:
            remove_folder(self.spark, path)
