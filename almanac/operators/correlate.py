"""Statistics of column pairs, all pairs in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pair:
    """Two metrics; rows count when every column in `needs` is present."""

    name: str
    first: str
    second: str
    needs: tuple[str, ...]


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; NULL when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pair_statistics(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """One row per pair, present even for empty input."""
    rows = F.array(*[_statistics(pair) for pair in pairs])
    return df.agg(rows.alias("pairs")).select(F.inline("pairs"))


def _statistics(pair: Pair) -> Column:
    counted = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pair.needs])
    x, y = F.when(counted, F.col(pair.first)), F.when(counted, F.col(pair.second))
    return F.struct(
        F.lit(pair.name).alias("metric_pair"),
        pearson(x, y).alias("correlation_coefficient"),
        F.count_if(counted).alias("sample_size"),
        F.avg(x).alias("metric_1_avg"),
        F.avg(y).alias("metric_2_avg"),
        F.stddev_samp(x).alias("metric_1_stddev"),
        F.stddev_samp(y).alias("metric_2_stddev"),
    )
