"""Questions users ask of the built tables directly."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.correlate import pearson
from almanac.operators.latest import latest_overall, rows_of_top_keys, stored_maximum


def latest_snapshot(fact: DataFrame, path: str | None = None) -> DataFrame:
    """`path`: where the fact is written; the latest date then comes from the files' footers and prunes what is read."""
    day = path and stored_maximum(fact.sparkSession, path, "report_date")
    latest = _on(fact, day) if day else latest_overall(fact, "report_date")
    return latest.select(
        "country_region", "province_state", "report_date", "confirmed_cases", "total_deaths",
        "daily_new_cases", "case_trend", "severity_category",
    )


def location_series(fact: DataFrame, province: str, data_source: str | None = None) -> DataFrame:
    rows = fact.filter(F.col("province_state") == province)
    if data_source is not None:
        rows = rows.filter(F.col("data_source") == data_source)
    return rows.select(
        "report_date", "confirmed_cases", "daily_new_cases", "confirmed_cases_7day_avg", "case_trend",
        "test_positivity_rate_pct",
    )


def compare_top_countries(fact: DataFrame, n: int = 5) -> DataFrame:
    return rows_of_top_keys(fact, "country_region", "confirmed_cases", n).select(
        "report_date", "country_region", "province_state", "daily_new_cases", "case_trend"
    )


def weekly_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("report_year", "week_of_year", "data_source").agg(
        F.sum("daily_new_cases").alias("weekly_new_cases"),
        F.avg("test_positivity_rate_pct").alias("avg_positivity"),
        F.count_distinct("location_name").alias("locations_reporting"),
    )


def top_values(df: DataFrame, column: str, frequency: str, measure: str, n: int = 5) -> DataFrame:
    """The n values of a column with the largest total, and the number of distinct `frequency` values."""
    return (
        df.groupBy(column)
        .agg(F.count_distinct(frequency).alias("frequency"), F.sum(measure).alias("total"))
        .orderBy(F.col("total").desc_nulls_first(), F.col(column).asc_nulls_last())
        .limit(n)
    )


def _on(fact: DataFrame, day: dt.date) -> DataFrame:
    """Rows of one date; the year picks the folders of the written fact, the date the row groups in them."""
    return fact.filter((F.col("report_year") == day.year) & (F.col("report_date") == F.lit(day)))


def countries_on(fact: DataFrame, day: dt.date) -> DataFrame:
    return _on(fact, day).groupBy("country_region").agg(
        F.sum("confirmed_cases").alias("total_cases"),
        F.sum("total_deaths").alias("total_deaths"),
        F.avg("case_fatality_ratio_pct").alias("avg_cfr"),
    )


def last_days(daily_summary: DataFrame, n: int = 30) -> DataFrame:
    return (
        daily_summary.select("snapshot_date", "new_cases_today", "cases_7day_rolling_avg",
                             "test_positivity_rate_pct", "case_trend")
        .orderBy(F.desc("snapshot_date"))
        .limit(n)
    )


def trailing_mean_total_on(fact: DataFrame, day: dt.date) -> DataFrame:
    """Trailing means may be added over locations of one date, not over dates."""
    return _on(fact, day).agg(
        F.sum("confirmed_cases_7day_avg").alias("total_7day_avg")
    )


def mean_ratio(fact: DataFrame, ratio: str = "case_fatality_ratio_pct") -> DataFrame:
    """Ratios are averaged, never added."""
    return fact.agg(F.avg(ratio).alias("avg_ratio"))


def us_correlations(fact: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One row with a correlation per named pair of columns over all US rows."""
    return fact.filter(F.col("data_source") == "US").agg(
        *[pearson(F.col(x), F.col(y)).alias(name) for name, (x, y) in pairs.items()]
    )


def totals(fact: DataFrame, *columns: str) -> DataFrame:
    return fact.agg(*[F.sum(c).alias(f"total_{c}") for c in columns])


def trend_of(trends: DataFrame, province: str) -> DataFrame:
    """The trend mart of one state, newest first."""
    return (
        trends.filter(F.col("province_state") == province)
        .select("report_date", "province_state", "cases_7day_moving_avg", "case_trend", "severity_category")
        .orderBy(F.desc("report_date"))
    )
