"""Declarative column tests as queries: not_null, unique, accepted_values."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnTest:
    """`failures` counts NULL rows, values that repeat, or distinct values outside the list."""

    column: str
    test: str
    values: tuple = ()


def not_null(column: str) -> ColumnTest:
    return ColumnTest(column, "not_null")


def unique(column: str) -> ColumnTest:
    return ColumnTest(column, "unique")


def accepted(column: str, *values) -> ColumnTest:
    return ColumnTest(column, "accepted_values", values)


def watched(df: DataFrame, tests: Sequence[ColumnTest]) -> tuple[DataFrame, Callable[[], dict[ColumnTest, int]]]:
    """`df`, which counts rows that fail a not_null or accepted_values test while it is written, and what asks for the counts afterwards."""
    counted = [t for t in tests if t.test != "unique"]
    if not counted:
        return df, dict
    seen = Observation()
    marked = df.observe(seen, *[F.count_if(_counted(t)).alias(f"t{i}") for i, t in enumerate(counted)])
    return marked, lambda: {t: seen.get[f"t{i}"] for i, t in enumerate(counted)}


def run_tests(
    tables: Mapping[str, DataFrame], tests: Mapping[str, Sequence[ColumnTest]], known: Mapping[str, Mapping[ColumnTest, int]] | None = None
) -> DataFrame:
    """One row per test of each table: model, column, test, failures, passed.

    `known` has rows that failed, as counted when a table was written. They decide not_null tests, and accepted_values
    tests that no row failed; what is left reads the tables.
    """
    decided, left = [], {m: [] for m in tables}
    for m in tables:
        counts = (known or {}).get(m)
        for t in tests[m]:
            failed = counts.get(t) if counts else None
            if failed is not None and (t.test == "not_null" or not failed):
                decided.append((m, t, failed))
            else:
                left[m].append(t)
    spark = next(iter(tables.values())).sparkSession
    rows = [(m, t.column, t.test, n, n == 0) for m, t, n in decided]
    parts = [spark.createDataFrame(rows, "model string, column string, test string, failures bigint, passed boolean")] if rows else []
    if any(left.values()):
        parts.append(_run(tables, left))
    return reduce(DataFrame.unionByName, parts)


def _run(tables: Mapping[str, DataFrame], tests: Mapping[str, Sequence[ColumnTest]]) -> DataFrame:
    """The same from the rows.

    Each table is read once for all its tests: a row yields an element of eight bytes per unique column,
    and one per not_null or accepted_values test that it fails, usually none. Elements are counted by test and
    key, combined before the one shuffle, so a value that repeats often is no hot key. The key of a value is its
    64-bit hash, which for types of up to eight bytes no two values share. Texts may: those columns are
    read again, and only rows whose hash failed are counted by their text. Where none did, nothing is read.
    """
    numbered = [(model, t) for model in tables for t in tests[model]]
    own = {m: [(i, t) for i, (model, t) in enumerate(numbered) if model == m] for m in tables if tests[m]}
    inexact = {m: [(i, t) for i, t in listed if t.test != "not_null" and not _is_exact(tables[m], t.column)] for m, listed in own.items()}
    inexact = {m: listed for m, listed in inexact.items() if listed}
    again = [i for listed in inexact.values() for i, _ in listed]
    unique_ids = [i for i, (_, t) in enumerate(numbered) if t.test == "unique"]
    fails = ~F.col("id").isin(unique_ids) | (F.col("rows") > 1)

    marks = reduce(DataFrame.unionByName, [_marks(tables[m], listed) for m, listed in own.items()])
    per_key = marks.groupBy("id", "key").agg(F.count("*").alias("rows")).filter(fails)
    failing = per_key.filter(~F.col("id").isin(again)).select("id", "rows")
    if inexact:
        texts = reduce(DataFrame.unionByName, [_texts(tables[m], listed) for m, listed in inexact.items()])
        seen = per_key.filter(F.col("id").isin(again)).select("id", "key")
        by_text = texts.join(seen, ["id", "key"], "left_semi").groupBy("id", "value").agg(F.count("*").alias("rows"))
        failing = failing.unionByName(by_text.filter(fails).select("id", "rows"))
    failing = failing.groupBy("id").agg(F.sum("rows").alias("rows"), F.count("*").alias("values"))

    declared = F.array(*[_declared(i, model, t) for i, (model, t) in enumerate(numbered)])
    wanted = next(iter(tables.values())).sparkSession.range(1).select(F.inline(declared))
    count = F.when(F.col("test") == "not_null", F.col("rows")).otherwise(F.col("values"))
    count = F.coalesce(count, F.lit(0)).cast("bigint")
    return wanted.join(failing, "id", "left").select(
        "model", "column", "test", count.alias("failures"), (count == 0).alias("passed")
    )


def _declared(number: int, model: str, test: ColumnTest) -> Column:
    parts = {"id": number, "model": model, "column": test.column, "test": test.test}
    return F.struct(*[F.lit(value).alias(name) for name, value in parts.items()])


def _is_exact(df: DataFrame, column: str) -> bool:
    """Whether the 64-bit hash of the column's type is one-to-one."""
    kind = df.select(column).schema[0].dataType
    return not isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) and not (
        isinstance(kind, T.DecimalType) and kind.precision > 18)


def _counted(test: ColumnTest) -> Column:
    """Whether a row's value is counted: for unique columns all values, else those that fail."""
    value = F.col(test.column)
    return {"not_null": value.isNull(), "unique": value.isNotNull(), "accepted_values": F.coalesce(~value.isin(*test.values), F.lit(False))}[test.test]


def _marks(df: DataFrame, tests: Sequence[tuple[int, ColumnTest]]) -> DataFrame:
    """(id, key): each value of the unique columns by its hash, and what fails another test."""
    mark = lambda n, t: F.struct(F.lit(n).alias("id"), F.when(_counted(t), F.xxhash64(t.column)).alias("key"))
    unique_marks = F.array(*[mark(n, t) for n, t in tests if t.test == "unique"]).cast("array<struct<id:int,key:bigint>>")
    others = [(n, t) for n, t in tests if t.test != "unique"]
    marks = unique_marks
    if others:
        failed = F.filter(F.array(*[mark(n, t) for n, t in others]), lambda m: m["key"].isNotNull())
        marks = F.when(reduce(Column.__or__, [_counted(t) for _, t in others]), F.concat(unique_marks, failed)).otherwise(unique_marks)
    return df.select(F.inline(marks)).where("key IS NOT NULL")


def _texts(df: DataFrame, tests: Sequence[tuple[int, ColumnTest]]) -> DataFrame:
    """(id, key, value) of the same for columns whose hashes do not tell all values apart."""
    texts = [F.struct(F.lit(n).alias("id"), F.xxhash64(t.column).alias("key"), F.when(_counted(t), F.col(t.column).cast("string")).alias("value")) for n, t in tests]
    return df.select(F.inline(F.array(*texts))).where("value IS NOT NULL")
