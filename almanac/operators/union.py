"""Union of tables whose columns and types drift."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.clean import normalize_names, quoted

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_REAL = [T.FloatType, T.DoubleType]
_TIME = [T.DateType, T.TimestampNTZType, T.TimestampType]


def common_type(types: list[T.DataType]) -> T.DataType:
    """The type that holds all values: whole -> double, date -> timestamp, otherwise text."""
    distinct = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if not distinct:
        return T.StringType()
    if len(distinct) == 1:
        return distinct[0]
    kinds = {type(t) for t in distinct}
    if kinds <= set(_WHOLE):
        return max(distinct, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, *_REAL, T.DecimalType}:
        return T.DoubleType()
    if kinds <= set(_TIME):
        return max(distinct, key=lambda t: _TIME.index(type(t)))
    return T.StringType()


def _normalized(df: DataFrame) -> DataFrame:
    names = normalize_names(df.columns)
    return df if names == df.columns else df.toDF(*names)


def union_drifting(inputs: Mapping[str, DataFrame], source_column: str = "_source") -> DataFrame:
    """All rows of all inputs under the superset of their (normalised) columns.

    A column absent from an input is NULL there; a column whose type differs is widened in
    every input before the union. `source_column` carries the name of the input, unless
    the input brings that column along.
    """
    if not inputs:
        raise ValueError("no input tables to union")
    named = {name: _normalized(df) for name, df in inputs.items()}
    types: dict[str, list[T.DataType]] = {}
    for df in named.values():
        for field in df.drop(source_column).schema.fields:
            types.setdefault(field.name, []).append(field.dataType)
    wanted = {column: common_type(found) for column, found in types.items()}

    branches = [
        df.select(
            *[
                (F.col(quoted(c)) if c in df.columns else F.lit(None)).cast(wanted[c]).alias(c)
                for c in wanted
            ],
            F.col(source_column) if source_column in df.columns else F.lit(name).alias(source_column),
        )
        for name, df in named.items()
    ]
    while len(branches) > 1:  # pairwise, so the plan stays shallow for many inputs
        branches = [
            branches[i].union(branches[i + 1]) if i + 1 < len(branches) else branches[i]
            for i in range(0, len(branches), 2)
        ]
    return branches[0]
