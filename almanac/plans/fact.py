"""The daily fact: both cleaned feeds, one row per report row, with keys, changes and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import labels
from almanac.functions import metrics as m
from almanac.functions.clean import utc_day
from almanac.operators.series import HOT_ROWS, SeriesMetrics, with_series

LOCATION = ["data_source", "country_region", "province_state", "admin2"]
# Buckets of the cleaned tables: the columns of a location that both feeds have.
PLACE = ("country_region", "province_state")
# Rows of one location and date are taken in the order of their source table, and then of what is
# measured: rows that still are equal give the same series in any order, whichever way it is computed.
SERIES_ORDER = ["report_date", "_source_table", "confirmed_cases", "total_deaths", "people_tested"]

# Columns both feeds share, and columns that one feed lacks with the type they have in the other.
_SHARED = [
    "country_region", "province_state", "fips_code", "latitude", "longitude", "confirmed_cases",
    "total_deaths", "total_recovered", "active_cases", "incident_rate_per_100k",
    "case_fatality_ratio_pct", "last_updated_at", "_staged_at", "_source_table",
]
_US_ONLY = {
    "iso3_code": "string", "uid": "bigint", "total_test_results": "bigint", "people_tested": "bigint",
    "people_hospitalized": "bigint", "testing_rate_per_100k": "double",
    "hospitalization_rate_pct": "double", "mortality_rate_pct": "double",
}
_GLOBAL_ONLY = {"admin2": "string"}

# Published column order of the fact.
FACT_COLUMNS = [
    "fact_key",
    "data_source", "country_region", "province_state", "admin2", "location_name",
    "fips_code", "iso3_code", "uid",
    "report_date", "report_year", "report_month", "report_day", "day_of_week", "week_of_year",
    "latitude", "longitude",
    "confirmed_cases", "total_deaths", "total_recovered", "active_cases",
    "total_test_results", "people_tested", "people_hospitalized",
    "daily_new_cases", "daily_new_deaths", "daily_new_tests",
    "pct_change_cases", "pct_change_deaths",
    "confirmed_cases_7day_avg", "deaths_7day_avg",
    "incident_rate_per_100k", "testing_rate_per_100k", "case_fatality_ratio_pct",
    "hospitalization_rate_pct", "mortality_rate_pct",
    "calculated_cfr_pct", "recovery_rate_pct", "test_positivity_rate_pct",
    "hospitalization_to_case_ratio_pct",
    "has_new_cases", "has_new_deaths", "case_trend", "severity_category",
    "last_updated_at", "_staged_at", "_source_table", "_fact_created_at",
]

# Folders of the written fact, and the order of rows in a file: questions about a date read little else.
FACT_FOLDERS = ("data_source", "report_year")
FACT_SORT = "report_date"

SERIES = SeriesMetrics(
    previous={"_prev_cases": "confirmed_cases", "_prev_deaths": "total_deaths", "_prev_tested": "people_tested"},
    trailing_mean={"_mean_cases": "confirmed_cases", "_mean_deaths": "total_deaths"},
)


def _absent(columns: dict[str, str]) -> list[Column]:
    return [F.lit(None).cast(dtype).alias(name) for name, dtype in columns.items()]


def combine_feeds(silver_us: DataFrame, silver_global: DataFrame) -> DataFrame:
    """Both feeds, aligned and stacked."""
    us, elsewhere = aligned_feeds(silver_us, silver_global)
    return us.unionByName(elsewhere)


def aligned_feeds(silver_us: DataFrame, silver_global: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both feeds with the same columns. The global feed's own US and unnamed rows are left out."""
    us = silver_us.filter(F.col("snapshot_date").isNotNull()).select(
        F.lit("US").alias("data_source"),
        F.col("snapshot_date").alias("report_date"),
        *_SHARED, *_US_ONLY, *_absent(_GLOBAL_ONLY),
    )
    elsewhere = silver_global.filter(~F.col("country_region").isin("US", "Unknown")).select(
        F.lit("Global").alias("data_source"),
        utc_day(F.col("last_updated_at")).alias("report_date"),
        *_SHARED, *_absent(_US_ONLY), *_GLOBAL_ONLY,
    )
    return us, elsewhere


def fact_daily(
    silver_us: DataFrame,
    silver_global: DataFrame,
    one_row_per_day: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One shuffle by location serves all five window columns, none for a feed in buckets by PLACE; the rest is row-wise.

    A location is in one feed. The series are computed before the feeds are stacked, where their buckets count.
    """
    us, elsewhere = (
        with_series(feed, LOCATION, SERIES_ORDER, SERIES, one_row_per_day, hot_rows) for feed in aligned_feeds(silver_us, silver_global)
    )
    rows = us.unionByName(elsewhere)

    cases, deaths, tested = F.col("confirmed_cases"), F.col("total_deaths"), F.col("people_tested")
    prev_cases, prev_deaths, prev_tested = F.col("_prev_cases"), F.col("_prev_deaths"), F.col("_prev_tested")
    key_parts = [
        F.col("data_source"), F.col("country_region"),
        F.coalesce("province_state", F.lit("")), F.coalesce("admin2", F.lit("")), F.col("report_date"),
    ]
    return rows.withColumns(
        {
            "fact_key": m.surrogate_key(*key_parts),
            "location_name": m.location_name(F.col("province_state"), F.col("country_region")),
            **m.date_parts(F.col("report_date")),
            "daily_new_cases": m.delta(cases, prev_cases),
            "daily_new_deaths": m.delta(deaths, prev_deaths),
            "daily_new_tests": m.delta(tested, prev_tested),
            "pct_change_cases": m.pct_change(cases, prev_cases),
            "pct_change_deaths": m.pct_change(deaths, prev_deaths),
            "confirmed_cases_7day_avg": m.round_quotient(F.col("_mean_cases"), 2),
            "deaths_7day_avg": m.round_quotient(F.col("_mean_deaths"), 2),
            "calculated_cfr_pct": m.safe_pct(deaths, cases),
            "recovery_rate_pct": m.safe_pct(F.col("total_recovered"), cases),
            "test_positivity_rate_pct": m.safe_pct(cases, tested),
            "hospitalization_to_case_ratio_pct": m.safe_pct(F.col("people_hospitalized"), cases),
            "has_new_cases": m.delta(cases, prev_cases) > 0,
            "has_new_deaths": m.delta(deaths, prev_deaths) > 0,
            "case_trend": labels.case_trend(cases, prev_cases),
            "severity_category": labels.SEVERITY(cases),
            "_fact_created_at": F.current_timestamp(),
        }
    ).select(*FACT_COLUMNS)
