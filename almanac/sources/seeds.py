"""Hand-kept CSV tables with inferred types, all of them from one scan.

A seed is a file `<name>.csv`, or a folder of that name with part files, anywhere under a root. The types of all
columns of all seeds come from one scan and one aggregate: every cell says which types cannot hold it, as a bit
mask, masks are combined by bitwise or, and a column has the first type that no cell rules out.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.clean import quoted
from almanac.sources.feeds import FEEDS
from almanac.sources.files import path_of, qualified
from almanac.sources.reports import _first_line_reader, _header_fetcher, _DIRECT_SCHEMES, _one_slash, _scan_headers, HEADER_CHUNK, FILES_PER_TASK

_WHOLE = r"^[+-]?\d{1,19}$"
_REAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?$"
#: Types in the order of preference, and what a cell of theirs looks like.
_TYPES = {"int": _WHOLE, "bigint": _WHOLE, "double": _REAL, "date": _DAY, "timestamp": _TIME, "boolean": "(?i)^(true|false)$"}


def seed_table_name(path: str, root: str) -> str:
    """<root>/us/2022.csv -> us_2022, <root>/2022.csv -> 2022"""
    inside = re.split(r"[/\\]", path.split(root.rstrip("/"), 1)[-1].strip("/"))
    stem = inside[-1].removesuffix(".csv")
    return f"{inside[-2]}_{stem}" if len(inside) > 1 else stem


def read_seeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The seeds under a folder, by table name.

    ValueError when two seeds would have one name, a seed the name of a feed, or parts of a seed differ in their header.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(root).select("path")
    scheme = qualified(spark, root).split(":", 1)[0]
    if scheme in _DIRECT_SCHEMES:
        headed = files.repartition(max(1, files.count() // FILES_PER_TASK)).mapInPandas(
            _header_fetcher(_first_line_reader(HEADER_CHUNK)), "path string, header string")
    else:
        headed = _scan_headers(files)
    listed = headed.select(_seed_of(F.col("path")).alias("seed"), "header").groupBy("seed").agg(F.collect_set("header").alias("headers")).collect()
    names = {row.seed: seed_table_name(row.seed, root) for row in listed}  # one entry for each table
    repeated = sorted({n for n in names.values() if [*names.values()].count(n) > 1})
    if repeated:
        raise ValueError(f"several seeds for the tables {repeated}")
    if taken := sorted(set(names.values()) & {*FEEDS, "_faults", "_contents", "_commits"}):
        raise ValueError(f"seeds with the names of feeds: {taken}")
    if odd := sorted(names[row.seed] for row in listed if len(row.headers) != 1):
        raise ValueError(f"seeds without a header, or with several: {odd}")
    columns = {row.seed: _names(row.headers[0]) for row in listed}
    types = _types(spark, root, columns)
    return {names[seed]: _typed(spark, seed, columns[seed], types.get(seed, [])) for seed in sorted(names)}


def _seed_of(path: Column) -> Column:
    """A file, or the folder *.csv that it is a part of."""
    return F.regexp_extract(path, r"^(.*?\.csv)(/|$)", 1)


def _names(header: str) -> list[str]:
    names = [n.strip() or f"_c{i}" for i, n in enumerate(next(csv.reader([header])))]
    return [n if names.count(n) == 1 else f"{n}{i}" for i, n in enumerate(names)]


def _cells(spark: SparkSession, path: str, width: int) -> DataFrame:
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.csv").csv(path)


def _types(spark: SparkSession, root: str, columns: Mapping[str, list[str]]) -> dict[str, list[str]]:
    """The type of each column of each seed."""
    width = max(map(len, columns.values()), default=0)
    if not width:
        return {}
    cells = _cells(spark, root, width).withColumn("_seed", _seed_of(_one_slash(path_of(F.col("_metadata.file_path")))))
    masks = cells.groupBy("_seed").agg(*[F.bit_or(_ruled_out(F.trim(f"_c{i}"))).alias(f"_m{i}") for i in range(width)])
    return {
        row._seed: [next((t for bit, t in enumerate(_TYPES) if not (row[f"_m{i}"] or 0) >> bit & 1), "string") for i in range(len(columns[row._seed]))]
        for row in masks.collect()
    }


def _ruled_out(cell: Column) -> Column:
    """Bits of the types that cannot hold a cell; none for an empty one."""
    masks = [F.when(cell.rlike(shape) & _cast(cell, kind).isNotNull(), 0).otherwise(1 << bit) for bit, (kind, shape) in enumerate(_TYPES.items())]
    return F.when(F.coalesce(cell, F.lit("")) == "", 0).otherwise(reduce(lambda a, b: a.bitwiseOR(b), masks))


def _cast(cell: Column, kind: str) -> Column:
    return cell.try_cast(kind)


def _typed(spark: SparkSession, path: str, names: list[str], types: list[str]) -> DataFrame:
    cells = _cells(spark, path, len(names))
    types = types or ["string"] * len(names)  # no rows
    value = lambda i: F.col(f"_c{i}") if types[i] == "string" else _cast(F.trim(f"_c{i}"), types[i])
    return cells.select(*[value(i).alias(name) for i, name in enumerate(names)])
