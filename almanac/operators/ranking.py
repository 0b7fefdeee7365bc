"""Ranks over all groups of an aggregate, shares of the total, and top rows.

The input of every function here is one row per group. A window without partitions runs
in one task, so it is used only up to ONE_TASK_ROWS groups, a number that is counted, not
assumed. Beyond it all ranks are numbered by one range shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from almanac.functions.metrics import round_half_up
from almanac.sources.stage import stage

ONE_TASK_ROWS = 1_000_000


@dataclass(frozen=True)
class Rank:
    """Row number by descending value; absent values come first, equal values go by the key."""

    name: str
    value: str


@dataclass(frozen=True)
class Percentile:
    """(rank - 1) / (rows - 1) by ascending value, to 4 places; 0 for a single row."""

    name: str
    value: str


def with_ranks(
    groups: DataFrame,
    key: str,
    ranks: Sequence[Rank],
    percentiles: Sequence[Percentile] = (),
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """`groups` must be cheap to read more than once: a table or a staged aggregate."""
    rows = groups.count()
    if rows <= one_task_rows:
        columns: dict[str, Column] = {}
        for r in ranks:
            columns[r.name] = F.row_number().over(Window.orderBy(*_descending(r.value, key))).cast("bigint")
        for p in percentiles:
            share = F.percent_rank().over(Window.orderBy(F.col(p.value).asc_nulls_last()))
            columns[p.name] = round_half_up(share, 4)
        return groups.withColumns(columns)

    return _ranked_in_ranges(groups, key, [*ranks, *percentiles], rows, one_task_rows)


def with_share(groups: DataFrame, value: str, name: str, whole: DataFrame | None = None) -> DataFrame:
    """Percentage of the total of `value`, to 2 places. `whole`: the groups to total, when others are left."""
    total = (whole or groups).agg(F.sum(value)).scalar()
    share = F.lit(100.0) * F.col(value) / F.nullif(total, F.lit(0))
    return groups.withColumn(name, round_half_up(share, 2))


def top_rows(groups: DataFrame, value: str, key: str, n: int, name: str) -> DataFrame:
    """The n largest groups with their rank. Each task keeps n rows; only those are numbered."""
    best = groups.orderBy(*_descending(value, key)).limit(n)
    return best.withColumn(name, F.row_number().over(Window.orderBy(*_descending(value, key))).cast("bigint"))


def _descending(value: str, key: str) -> list[Column]:
    return [F.col(value).desc_nulls_first(), F.col(key).asc_nulls_last()]


_IN_PARTITION = 33  # bits of monotonically_increasing_id that count inside a partition


def _ranked_in_ranges(groups: DataFrame, key: str, columns: Sequence[Rank | Percentile], rows: int, one_task_rows: int) -> DataFrame:
    """All ranks from one range shuffle and one staged table, whatever their number, joined back to the groups once.

    Every group gives an entry for each rank. Entries are dealt to ranges by (rank, value, key) and sorted there; an
    entry's place in its range, plus the sizes of the ranges before, less the entries of the ranks before, is its number.
    """
    places = range(len(columns))
    entry = lambda i: F.struct(F.lit(i).alias("_rank"), F.col(key).alias("_key"), *[
        (F.col(c.value) if i == j else F.lit(None).cast(groups.schema[c.value].dataType)).alias(f"_v{j}") for j, c in enumerate(columns)])
    order = [F.col("_rank").asc()]
    order += [F.col(f"_v{i}").desc_nulls_first() if isinstance(c, Rank) else F.col(f"_v{i}").asc_nulls_last() for i, c in enumerate(columns)]
    order.append(F.col("_key").asc_nulls_last())
    ranges = 2 * len(columns) * math.ceil(rows / one_task_rows)
    # Staged, because a second evaluation could sample other range bounds.
    sorted_entries = stage(
        groups.select(F.inline(F.array(*map(entry, places)))).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()), "ranges")
    in_range = F.shiftright("_id", _IN_PARTITION)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sorted_entries.groupBy(in_range.alias("_range")).count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col("_id").bitwiseAND(F.lit((1 << _IN_PARTITION) - 1)) - F.col("_rank") * F.lit(rows) + 1
    # One offset per range: the broadcast holds `ranges` rows.
    numbered = sorted_entries.join(F.broadcast(offsets), in_range == F.col("_range")).withColumn("_number", place.cast("bigint"))

    shared = [i for i in places if isinstance(columns[i], Percentile)]
    if shared:
        # Equal values share the smallest number; grouped first, so a frequent value is one row.
        # Written, so that its true size decides about a broadcast, which a frequent value needs.
        own = [F.col(f"_v{i}").alias(f"_w{i}") for i in shared]
        first = numbered.where(F.col("_rank").isin(shared)).groupBy(F.col("_rank").alias("_of"), *own).agg(F.min("_number").alias("_first"))
        same = reduce(Column.__and__, [F.col(f"_v{i}").eqNullSafe(F.col(f"_w{i}")) for i in shared], F.col("_rank") == F.col("_of"))
        numbered = numbered.join(stage(first, "first"), same, "left")
    share = lambda: round_half_up((F.col("_first") - 1) / F.lit(float(max(rows - 1, 1))), 4)
    value = [F.col("_number") if isinstance(c, Rank) else share() for c in columns]
    by_key = numbered.groupBy(F.col("_key")).agg(*[F.max(F.when(F.col("_rank") == i, value[i])).alias(c.name) for i, c in enumerate(columns)])
    return groups.join(by_key, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
