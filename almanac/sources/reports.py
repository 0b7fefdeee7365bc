"""Daily report files to the bronze dataset.

A feed is a folder of CSV files named MM-DD-YYYY.csv, each with a header row. Headers
drift: columns come, go, move and change spelling. All files are parsed in one scan by
position; what a position means is looked up by the file's header. Cells stay text in bronze.

A load replaces in bronze exactly the files it accepted, those without rows included, in one step;
repeating it changes nothing. What a load left out is kept as a table of faults.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.clean import is_whole, na_to_null, normalize_names, quoted
from almanac.sources.bronze import Bronze
from almanac.sources.feeds import FEEDS, REQUIRED, typed_cell
from almanac.sources.files import path_of, qualified
from almanac.sources.stage import stage

LISTING = "path string, time long, length long"
OPEN_QUOTE, SURPLUS, MISFIT = "quote left open", "row longer than the header", "cell of the wrong type"
HEADER_CHUNK = 64 * 1024
FILES_PER_TASK = 200
# File systems whose first bytes a task can fetch directly, and the names of the same under Hadoop;
# others are scanned by Spark.
_DIRECT_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def list_reports(spark: SparkSession, folder: str) -> DataFrame:
    """(path, time, length) of all report files of a folder, empty ones included; contents are not read.

    A task lists the folder, so its names do not pass the driver. File systems that only Spark can read
    are listed by Spark, which leaves empty files out of a scan; the driver adds those.
    """
    root = qualified(spark, folder)
    scheme = root.split(":", 1)[0]
    if scheme in _DIRECT_SCHEMES:
        return spark.createDataFrame([(root,)], "path string").mapInPandas(_lister(_DIRECT_SCHEMES), LISTING)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    listed = files.select("path", F.unix_millis("modificationTime").alias("time"), "length")
    names = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string").select(_one_slash(path_of(F.col("path"))).alias("path"))
    empty = names.join(listed, "path", "left_anti").select("path", F.lit(0).cast("long").alias("time"), F.lit(0).cast("long").alias("length"))
    return listed.unionByName(empty)


def _lister(schemes: Mapping[str, str]) -> Callable:
    """A function that runs in tasks, built here so that it travels by value: the report files of folders."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for root in batch["path"]:
                scheme, rest = root.split(":", 1)
                rest = "//" + "/" + rest.lstrip("/") if scheme == "file" else rest
                files, name = fs.FileSystem.from_uri(f"{schemes[scheme]}:{quote(rest)}")
                found = [f for f in files.get_file_info(fs.FileSelector(name)) if f.type == fs.FileType.File and f.base_name.endswith(".csv")
                         and f.base_name[0] not in "._"]
                yield pd.DataFrame({
                    "path": [f"{root.rstrip('/')}/{f.base_name}" for f in found],
                    "time": [(f.mtime_ns or 0) // 1_000_000 for f in found], "length": [f.size or 0 for f in found]})

    return run


def read_headers(files: DataFrame, folder: str | None = None) -> DataFrame:
    """The first line of each file, NULL when the file is gone, empty or no UTF-8 text.

    `folder`, where it is known, saves the driver the names of files that only Spark can read.
    """
    scheme = files.limit(1).select(F.regexp_extract("path", r"^(\w+):", 1)).collect()
    if scheme and scheme[0][0] not in _DIRECT_SCHEMES:
        return _scan_headers(files, folder)
    tasks = max(1, files.count() // FILES_PER_TASK)
    fetch = _header_fetcher(_first_line_reader(HEADER_CHUNK))
    return files.select("path").repartition(tasks).mapInPandas(fetch, "path string, header string")


def _first_line_reader(chunk_bytes: int, schemes: Mapping[str, str] = _DIRECT_SCHEMES) -> Callable[[str], str | None]:
    """A function that runs in tasks. It is built here, so that it travels to the executors by
    value and they need no copy of this package. Errors of the store fail the task, which Spark repeats."""

    def first_line(path: str) -> str | None:
        from pyarrow import fs

        scheme, rest = path.split(":", 1)
        if scheme == "file":
            rest = "//" + "/" + rest.lstrip("/")
        files, name = fs.FileSystem.from_uri(f"{schemes[scheme]}:{quote(rest)}")
        start, done = bytearray(), False
        try:
            with files.open_input_stream(name) as stream:
                while not done:
                    chunk = stream.read(chunk_bytes)
                    start += chunk
                    done = not chunk or b"\n" in chunk
            return bytes(start).split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8-sig") or None
        except (FileNotFoundError, UnicodeDecodeError):
            return None

    return first_line


def _header_fetcher(first_line: Callable[[str], str | None]) -> Callable:
    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "header": [first_line(p) for p in batch["path"]]})

    return fetch


def _scan_headers(files: DataFrame, folder: str | None = None) -> DataFrame:
    """The same through a text scan, for file systems that only Spark can read."""
    spark = files.sparkSession
    paths = folder or [row.path for row in files.select("path").collect()]
    lines = spark.read.option("pathGlobFilter", "*.csv").text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    first = lines.filter(F.col("start") == 0).groupBy("uri").agg(F.min_by("value", "at").alias("line"))
    line = F.regexp_replace("line", "^\ufeff|\r$", "")
    header = F.when(~line.contains("\ufffd"), F.nullif(line, F.lit("")))
    found = first.select(_one_slash(path_of(F.col("uri"))).alias("path"), header.alias("header"))
    return files.select("path").join(found, "path", "left")


def usable_columns(header: str | None, feed: str, aliases: Mapping[str, str] | None = None) -> list[str]:
    """Normalised names of a header line, aliases replaced; ValueError when the line cannot head a report."""
    if header is None:
        raise ValueError("no readable header")
    names: list[str] = []
    seen: Counter[str] = Counter()
    for at, name in enumerate(next(csv.reader([header]))):
        name = name if name.strip() else f"Unnamed: {at}"
        names.append(f"{name}.{seen[name]}" if seen[name] else name)  # a repeated name is numbered
        seen[name] += 1
    names = normalize_names([(aliases or {}).get(n, n) for n in normalize_names(names)])
    if not set(names) & set(FEEDS[feed]):
        raise ValueError("header without any known column")
    return names


def ingest_reports(
    spark: SparkSession, landing: str, feed: str, bronze: str, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Load all files of <landing>/<feed> into <bronze>/<feed>; returns what this load left out, and why.

    `aliases` maps other normalised spellings to the columns that the cleaned tables read,
    as {"case-fatality_ratio": "case_fatality_ratio"}. Without it such columns are kept in
    bronze under their own names. The faults stay with the load (`read_faults`).
    """
    folder = f"{landing}/{feed}"
    files = stage(list_reports(spark, folder), "listing")
    return _ingest(files, folder, lambda reader: reader.option("pathGlobFilter", "*.csv").csv(folder), feed, bronze, aliases)


def ingest_files(
    files: DataFrame, feed: str, bronze: str, aliases: Mapping[str, str] | None = None, label: str | None = None
) -> DataFrame:
    """The same for the given files (path, time, length), a bounded number: their paths pass through the driver. A later load with the same label replaces this one's faults."""
    files = stage(files.select("path", "time", "length"), "listing")
    paths = [row.path for row in files.where("length > 0").select("path").collect()]
    read = lambda reader: reader.csv(paths)
    return _ingest(files, None, read, feed, bronze, aliases, label)


def changed_files(spark: SparkSession, landing: str, feed: str, bronze: str) -> DataFrame:
    """(path, time, length) of the files that loads have seen and that have since been replaced under their names."""
    now = list_reports(spark, f"{landing}/{feed}").withColumn("file", _name_of("path"))
    seen = Bronze(spark, bronze, feed).files().select(F.col("file").alias("_file"), F.col("time").alias("_time"), F.col("length").alias("_length"))
    differs = (F.col("time") != F.col("_time")) | (F.col("length") != F.col("_length"))
    return now.join(seen, (F.col("file") == F.col("_file")) & differs).select("path", "time", "length")


def _one_slash(uri: Column) -> Column:
    return F.regexp_replace(uri, "^file:///", "file:/")


def _name_of(path: str) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def _ingest(files: DataFrame, folder: str | None, read: Callable[[DataFrameReader], DataFrame], feed: str, bronze: str,
            aliases: Mapping[str, str] | None, label: str | None = None) -> DataFrame:
    """A file is left out whole when its header cannot be used or a quote in it is never closed.

    A row is left out when it has more cells than its header, or a required cell (a count, the
    date) that does not fit its type. Any other cell that does not fit is empty in the cleaned
    tables, and its row is loaded.
    """
    spark = files.sparkSession
    empty = files.where("length = 0").select(_name_of("path").alias("_file"), F.lit("").alias("header"))
    heads = stage(read_headers(files.where("length > 0"), folder).select(_name_of("path").alias("_file"), "header").unionByName(empty), "headers")
    signatures, refused = _signatures([row.header for row in heads.select("header").distinct().collect()], feed, aliases)
    known = heads.join(_small(spark, [(head, i) for i, (head, _) in enumerate(signatures)], "_head string, _signature int"),
                       F.col("header") == F.col("_head")).select("_file", "_signature")
    why = _small(spark, refused, "_head string, reason string")
    unusable = heads.join(why, F.col("header").eqNullSafe(F.col("_head"))).select("_file", "reason")

    rows, torn = _no_rows(spark), []
    if signatures:
        rows = stage(_parsed(spark, read, known, signatures, feed, multi_line=False), "rows")
        torn = [row._file for row in rows.where("_open").select("_file").distinct().collect()]
    if torn:  # Files with cells that span lines are few; only their rows come from a parse of whole files.
        files_of = lambda reader: read(reader).where(F.col("_metadata.file_name").isin(torn))  # noqa: E731  skips the other files
        whole = _parsed(spark, files_of, known, signatures, feed, multi_line=True)
        rows = stage(rows.where(~F.col("_file").isin(torn)).unionByName(whole), "rows")
        torn = [row._file for row in rows.where("_open").select("_file").distinct().collect()]
    accepted = known.where(~F.col("_file").isin(torn)).select("_file") if torn else known.select("_file")
    usable = rows.where(~F.col("_file").isin(torn)) if torn else rows

    files_out = unusable.unionByName(_small(spark, [(name, OPEN_QUOTE) for name in torn], "_file string, reason string"))
    found = _faults(usable, files_out, feed)
    place = Bronze(spark, bronze, feed)
    seen = files.select(_name_of("path").alias("file"), "time", "length")
    if signatures:
        loaded = usable.where(~F.col("_left_out")).drop("_open", "_left_out", "_surplus", "_misfits", "_line", "_signature")
        load = place.load(loaded, accepted, {name for _, names in signatures for name in names}, found, label, seen)
    else:
        load = place.load(faults=found, label=label, seen=seen)
    return place.faults_of(load)


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "_file string, _open boolean, _left_out boolean, _surplus boolean, _line string, "
                                     "_misfits array<struct<column:string,cell:string>>")


def _signatures(
    headers: list[str | None], feed: str, aliases: Mapping[str, str] | None
) -> tuple[list[tuple[str, list[str]]], list[tuple[str | None, str]]]:
    """(header, column names) of the headers that can be used, (header, reason) of the others; one entry per distinct header."""
    usable, refused = [], []
    for header in sorted(headers, key=str):
        try:
            usable.append((header, usable_columns(header, feed, aliases)))
        except ValueError as fault:
            refused.append((header, "empty file" if header == "" else str(fault)))
    return usable, refused


def _parsed(spark: SparkSession, read: Callable[[DataFrameReader], DataFrame], known: DataFrame, signatures: list[tuple[str, list[str]]],
            feed: str, multi_line: bool) -> DataFrame:
    """The rows of the known files under their column names, with what is wrong with them."""
    width = max(len(names) for _, names in signatures)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*(f"_c{i}" for i in range(width)), "_raw"]])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_raw")
        .option("columnPruning", False)  # a pruned read would not notice rows of another length
    )
    # _raw is set for rows whose length differs from the widest header. Their cells are the pieces
    # between commas outside quotes; a quote opened in the last cell and never closed ends with its line.
    raw = F.coalesce("_raw", F.lit(""))
    closed = F.regexp_replace(raw, '"[^"]*"', "")
    cells = F.when(F.col("_raw").isNull(), F.lit(width)).otherwise(F.size(F.split(F.regexp_replace(closed, '"[^"]*$', ""), ",")))
    by_signature = lambda values: _chosen("_signature", dict(enumerate(values)))
    own_width = by_signature([F.lit(len(names)) for _, names in signatures])
    every = list(dict.fromkeys(name for _, names in signatures for name in names))
    named = {
        name: na_to_null(_chosen("_signature", {i: F.col(f"_c{names.index(name)}") for i, (_, names) in enumerate(signatures) if name in names}))
        for name in every
    }
    placed = read(reader).withColumn("_file", F.col("_metadata.file_name")).join(known, "_file")
    rows = placed.select(
        *[cell.alias(name) for name, cell in named.items()], "_file", "_signature",
        (cells > own_width).alias("_surplus"),
        (closed.contains('"') & (cells != own_width)).alias("_open"),
        F.col("_raw"),
    )
    typed = {c: t for c, t in FEEDS[feed].items() if t != "string" and c in every}
    wrong = [F.when(_misfit(c, t), F.struct(F.lit(c).alias("column"), F.col(c).alias("cell"))) for c, t in typed.items()]
    misfits = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<struct<column:string,cell:string>>")
    rows = rows.withColumn("_misfits", misfits)
    left_out = F.col("_surplus") | F.exists("_misfits", lambda m: m["column"].isin(*REQUIRED))
    line = F.coalesce("_raw", F.to_json(F.struct(*[quoted(name) for name in every])))
    return rows.withColumn("_left_out", left_out).withColumn("_line", F.when(F.col("_left_out") | (F.size("_misfits") > 0), line)).drop("_raw")


def _chosen(column: str, values: Mapping[int, Column]) -> Column:
    chain = F
    for key, value in values.items():
        chain = chain.when(F.col(column) == key, value)
    return chain


def _faults(rows: DataFrame, files_out: DataFrame, feed: str) -> DataFrame:
    """Everything that is left out: files, rows and cells."""
    none = F.lit(None).cast("string")
    whole = files_out.select(F.col("_file").alias("file"), F.lit("file").alias("left_out"), "reason",
                             none.alias("column"), none.alias("cell"), none.alias("line"))
    long = rows.where("_surplus").select(F.col("_file").alias("file"), F.lit("row").alias("left_out"), F.lit(SURPLUS).alias("reason"),
                                         none.alias("column"), none.alias("cell"), F.col("_line").alias("line"))
    odd = rows.where("NOT _surplus").select("_file", "_left_out", "_line", F.explode("_misfits").alias("_m")).select(
        F.col("_file").alias("file"), F.when(F.col("_left_out"), F.lit("row")).otherwise(F.lit("cell")).alias("left_out"),
        F.lit(MISFIT).alias("reason"), F.col("_m.column").alias("column"), F.col("_m.cell").alias("cell"), F.col("_line").alias("line"))
    return reduce(DataFrame.unionByName, [whole, long, odd]).select(F.lit(feed).alias("feed"), "file", "left_out", "reason", "column", "cell", "line")


def report_empty_files(spark: SparkSession, landing: str, feed: str, bronze: str) -> None:
    """Keep which files of a feed have no content now; for loads that are only told of files with content."""
    empty = list_reports(spark, f"{landing}/{feed}").where("length = 0").select(_name_of("path").alias("_file"), F.lit("empty file").alias("reason"))
    Bronze(spark, bronze, feed).load(faults=_faults(_no_rows(spark), empty, feed), label="empty files")


def read_faults(spark: SparkSession, bronze: str, feed: str) -> DataFrame:
    """What all loads of a feed left out."""
    return Bronze(spark, bronze, feed).faults()


def _misfit(column: str, dtype: str) -> Column:
    written = F.coalesce(F.trim(F.col(column)), F.lit("")) != ""
    return written & (~is_whole(F.col(column)) if dtype == "bigint" else typed_cell(column, dtype).isNull())


def read_bronze(spark: SparkSession, bronze: str, feed: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Bronze rows of a feed as text cells plus lineage: `columns`, or those columns of the cleaned table that a file has had."""
    return Bronze(spark, bronze, feed).read(columns)
