"""Previous-row and trailing-mean metrics per location.

"Previous" and "7" count rows, not calendar days: gaps in a series are not filled.

A location is one window partition, hence one task. That is right while a location holds
at most a few million rows. Locations beyond HOT_ROWS are cut into blocks of about
BLOCK_ROWS consecutive rows that run in different tasks; each block first receives the
last rows before it, so the results are the same as over the whole location.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from almanac.sources.stage import stage

HOT_ROWS = 5_000_000
BLOCK_ROWS = 1_000_000
TRAILING_ROWS = 7


@dataclass(frozen=True)
class SeriesMetrics:
    """Output name -> input column, for the previous value and the trailing mean."""

    previous: dict[str, str]
    trailing_mean: dict[str, str]

    @property
    def inputs(self) -> list[str]:
        return sorted({*self.previous.values(), *self.trailing_mean.values()})

    def over(self, window: WindowSpec) -> dict[str, Column]:
        trailing = window.rowsBetween(1 - TRAILING_ROWS, Window.currentRow)
        columns = {name: F.lag(source).over(window) for name, source in self.previous.items()}
        columns |= {name: F.avg(source).over(trailing) for name, source in self.trailing_mean.items()}
        return columns


def with_series(
    df: DataFrame,
    location: Sequence[str],
    order: Sequence[str],
    metrics: SeriesMetrics,
    one_row_per_day: bool = False,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the metrics, rows of a location taken in `order` (absent dates last).

    `order` should decide between any two rows that differ in the inputs: then the result is
    the same whichever way it is computed, at any size and after any retry.

    `one_row_per_day` states that the caller has grouped by location and date, so that a
    location cannot outgrow the calendar and the count of rows per location is not needed.
    """
    if not one_row_per_day:
        hot = _hot_locations(df, location, hot_rows)
        if not hot.isEmpty():
            return _with_split_series(df, location, order, metrics, hot, block_rows)
    return df.withColumns(metrics.over(_location_window(location, order)))


def whole_series(order: str) -> WindowSpec:
    """One series over all rows. Only for rows grouped by date: the calendar bounds them."""
    return Window.orderBy(F.col(order).asc_nulls_last())


def _location_window(location: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*location).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def _hot_locations(df: DataFrame, location: Sequence[str], hot_rows: int) -> DataFrame:
    """Hashes of the locations with more than `hot_rows` rows; a collision only adds a location."""
    counts = df.groupBy(F.xxhash64(*location).alias("_location")).count()
    return stage(counts.filter(F.col("count") > hot_rows).select("_location"), "hot_locations")


def _with_split_series(
    df: DataFrame,
    location: Sequence[str],
    order: Sequence[str],
    metrics: SeriesMetrics,
    hot: DataFrame,
    block_rows: int,
) -> DataFrame:
    marked = df.withColumn("_location", F.xxhash64(*location))
    cold = marked.join(hot, "_location", "left_anti").drop("_location")
    # Both tables are written: the row number orders equal rows, the block is a range of the
    # whole order, and neither may come out differently for another reader or after a retry.
    numbered = stage(
        marked.join(hot, "_location", "left_semi").drop("_location")
        .withColumn("_row", F.monotonically_increasing_id()),
        "hot_rows",
    )
    sequence = [F.col(c).asc_nulls_last() for c in [*order, "_row"]]
    blocks = stage(
        numbered.repartitionByRange(math.ceil(numbered.count() / block_rows), *location, *sequence)
        .withColumn("_block", F.spark_partition_id()),
        "hot_blocks",
    )

    led = blocks.withColumn("_lead_in", F.lit(False)).unionByName(
        _lead_in(blocks, location, order, metrics), allowMissingColumns=True
    )
    in_block = Window.partitionBy(*location, "_block").orderBy(F.desc("_lead_in"), *sequence)
    split = led.withColumns(metrics.over(in_block)).filter(~F.col("_lead_in"))
    return cold.withColumns(metrics.over(_location_window(location, order))).unionByName(
        split.drop("_row", "_block", "_lead_in")
    )


def _lead_in(
    blocks: DataFrame, location: Sequence[str], order: Sequence[str], metrics: SeriesMetrics
) -> DataFrame:
    """For each block of a location, copies of the last rows before it.

    Only the last `reach` rows of a block can be needed later, so the per-location
    window below sees a handful of rows per block, never the location's rows.
    """
    reach = TRAILING_ROWS - 1
    place = [*order, "_row"]
    carried = list(dict.fromkeys([*place, *metrics.inputs]))
    forward = [F.col(c).asc_nulls_last() for c in place]
    backward = [F.col(c).desc_nulls_first() for c in place]
    block = Window.partitionBy(*location, "_block")
    ends = (
        blocks.select(*location, "_block", *carried)
        .withColumn("_back", F.row_number().over(block.orderBy(*backward)))
        .filter(F.col("_back") <= reach)
    )
    earlier = Window.partitionBy(*location).orderBy("_block", *forward).rowsBetween(-reach, -1)
    firsts = (
        ends.withColumn("_earlier", F.collect_list(F.struct(*carried)).over(earlier))
        .withColumn("_nth", F.row_number().over(block.orderBy(*forward)))
        .filter(F.col("_nth") == 1)
    )
    return firsts.select(*location, "_block", F.explode("_earlier").alias("_values")).select(
        *location, "_block", F.lit(True).alias("_lead_in"), *[F.col("_values")[c].alias(c) for c in carried]
    )
