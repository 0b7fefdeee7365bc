"""Group totals kept on every row of the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.sources.stage import stage


def with_group_totals(df: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Attach aggregates of each group to its rows; absent key parts form groups as well.

    Grouping first combines rows before any shuffle, so a group of any size is cheap. The
    staged totals have a known size: below Spark's threshold they are broadcast and the
    rows are not shuffled; beyond it the join splits skewed partitions.
    """
    grouped = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[total.alias(name) for name, total in totals.items()]
    )
    grouped = stage(grouped, "group_totals")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(grouped, same).drop(*[f"_{k}" for k in keys])
