"""Summaries of the fact: by day, by state, by country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from almanac.functions import labels
from almanac.functions import metrics as m
from almanac.operators.ranking import ONE_TASK_ROWS, Percentile, Rank, with_ranks, with_share
from almanac.operators.series import TRAILING_ROWS, whole_series
from almanac.sources.stage import stage

RATES = ["incident_rate_per_100k", "case_fatality_ratio_pct", "testing_rate_per_100k",
         "hospitalization_rate_pct", "mortality_rate_pct"]


def us_rows(fact: DataFrame, *present: str) -> DataFrame:
    rows = fact.filter(F.col("data_source") == "US")
    for column in present:
        rows = rows.filter(F.col(column).isNotNull())
    return rows


def _mean_rates(rates: list[str]) -> list[Column]:
    return [m.round_half_up(F.avg(r), 2).alias(f"avg_{r}") for r in rates]


def day_totals(fact: DataFrame) -> DataFrame:
    """US totals and mean rates per report date."""
    sums = {"confirmed_cases": "total_confirmed_cases", "total_deaths": "total_deaths",
            "total_recovered": "total_recovered", "active_cases": "total_active_cases",
            "people_tested": "total_people_tested", "people_hospitalized": "total_people_hospitalized"}
    return us_rows(fact, "report_date").groupBy(F.col("report_date").alias("snapshot_date")).agg(
        *[F.sum(c).alias(name) for c, name in sums.items()],
        *_mean_rates(RATES),
        F.count_distinct("province_state").alias("states_reporting"),
    )


def daily_summary(fact: DataFrame) -> DataFrame:
    series = whole_series("snapshot_date")
    trailing = series.rowsBetween(1 - TRAILING_ROWS, Window.currentRow)
    cases, deaths = F.col("total_confirmed_cases"), F.col("total_deaths")
    days = day_totals(fact).withColumns(
        {
            "_prev_cases": F.lag(cases).over(series),
            "_prev_deaths": F.lag(deaths).over(series),
            "_mean_cases": F.avg(cases).over(trailing),
            "_mean_deaths": F.avg(deaths).over(trailing),
        }
    )
    return days.select(
        "snapshot_date", "total_confirmed_cases", "total_deaths", "total_recovered", "total_active_cases",
        "total_people_tested", "total_people_hospitalized",
        m.delta(cases, F.col("_prev_cases")).alias("new_cases_today"),
        m.delta(deaths, F.col("_prev_deaths")).alias("new_deaths_today"),
        m.round_half_up(F.col("_mean_cases"), 2).alias("cases_7day_rolling_avg"),
        m.round_half_up(F.col("_mean_deaths"), 2).alias("deaths_7day_rolling_avg"),
        *[f"avg_{r}" for r in RATES],
        m.safe_pct(deaths, cases).alias("overall_case_fatality_ratio_pct"),
        m.safe_pct(cases, F.col("total_people_tested")).alias("test_positivity_rate_pct"),
        "states_reporting",
        labels.total_trend(cases, F.col("_prev_cases")).alias("case_trend"),
    )


def state_totals(fact: DataFrame) -> DataFrame:
    """Largest values and plain mean rates per US state."""
    peaks = {"confirmed_cases": "total_confirmed_cases", "total_deaths": "total_deaths",
             "total_recovered": "total_recovered", "people_tested": "total_people_tested",
             "people_hospitalized": "total_people_hospitalized"}
    return us_rows(fact, "province_state").groupBy("province_state").agg(
        F.count_distinct("report_date").alias("days_reporting"),
        F.max("report_date").alias("latest_report_date"),
        *[F.max(c).alias(name) for c, name in peaks.items()],
        *[F.avg(r).alias(f"avg_{r}") for r in RATES],
    )


def state_summary(fact: DataFrame, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    cases, deaths = F.col("total_confirmed_cases"), F.col("total_deaths")
    ranked = with_ranks(
        stage(state_totals(fact), "state_totals"),
        "province_state",
        [
            Rank("national_rank_cases", "total_confirmed_cases"),
            Rank("national_rank_deaths", "total_deaths"),
            # ranked by the unrounded mean; a state without rates ranks first
            Rank("national_rank_incident_rate", "avg_incident_rate_per_100k"),
        ],
        [Percentile("cases_percentile", "total_confirmed_cases"), Percentile("deaths_percentile", "total_deaths")],
        one_task_rows,
    )
    return ranked.select(
        "province_state", "days_reporting", "latest_report_date", "total_confirmed_cases", "total_deaths",
        "total_recovered", "total_people_tested", "total_people_hospitalized",
        "national_rank_cases", "national_rank_deaths", "national_rank_incident_rate",
        "cases_percentile", "deaths_percentile",
        *[m.round_half_up(F.col(f"avg_{r}"), 2).alias(f"avg_{r}") for r in RATES],
        m.safe_pct(deaths, cases).alias("overall_case_fatality_ratio_pct"),
        m.safe_pct(cases, F.col("total_people_tested")).alias("test_positivity_rate_pct"),
        cases.alias("peak_confirmed_cases"),
        deaths.alias("peak_deaths"),
        labels.STATE_IMPACT(F.col("national_rank_cases")).alias("impact_category"),
    )


def country_totals(fact: DataFrame) -> DataFrame:
    """Totals over all dates per country (the counts are running totals; this sums them as published).

    Rows are first combined per location, so the distinct counts work on locations, not rows.
    """
    sums = {"confirmed_cases": "total_confirmed_cases", "total_deaths": "total_deaths",
            "total_recovered": "total_recovered", "active_cases": "total_active_cases"}
    means = ["incident_rate_per_100k", "case_fatality_ratio_pct"]
    locations = (
        fact.filter(F.col("country_region") != "Unknown")
        .groupBy("country_region", "province_state", "location_name")
        .agg(
            F.count("*").alias("_rows"),
            *[F.sum(c).alias(name) for c, name in sums.items()],
            *[F.sum(r).alias(f"_sum_{r}") for r in means],
            *[F.count(r).alias(f"_n_{r}") for r in means],
            F.max("confirmed_cases").alias("_max_cases"),
            F.max("total_deaths").alias("_max_deaths"),
        )
    )
    return locations.groupBy("country_region").agg(
        F.sum("_rows").alias("data_points"),
        F.count_distinct("province_state").alias("provinces_reporting"),
        F.count_distinct("location_name").alias("unique_locations"),
        *[F.sum(name).alias(name) for name in sums.values()],
        *[F.try_divide(F.sum(f"_sum_{r}"), F.sum(f"_n_{r}")).alias(f"avg_{r}") for r in means],
        F.max("_max_cases").alias("max_single_location_cases"),
        F.max("_max_deaths").alias("max_single_location_deaths"),
    )


def country_summary(fact: DataFrame, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    cases, deaths = F.col("total_confirmed_cases"), F.col("total_deaths")
    totals = stage(country_totals(fact), "country_totals")
    ranked = with_ranks(
        totals,
        "country_region",
        [
            Rank("global_rank_cases", "total_confirmed_cases"),
            Rank("global_rank_deaths", "total_deaths"),
            Rank("global_rank_recovered", "total_recovered"),
        ],
        one_task_rows=one_task_rows,
    )
    ranked = with_share(ranked, "total_confirmed_cases", "pct_of_global_cases", totals)
    ranked = with_share(ranked, "total_deaths", "pct_of_global_deaths", totals)
    return ranked.select(
        "country_region", "data_points", "provinces_reporting", "unique_locations",
        "total_confirmed_cases", "total_deaths", "total_recovered", "total_active_cases",
        "global_rank_cases", "global_rank_deaths", "global_rank_recovered",
        "pct_of_global_cases", "pct_of_global_deaths",
        m.round_half_up(F.col("avg_incident_rate_per_100k"), 2).alias("avg_incident_rate_per_100k"),
        m.round_half_up(F.col("avg_case_fatality_ratio_pct"), 2).alias("avg_case_fatality_ratio_pct"),
        m.safe_pct(deaths, cases).alias("overall_case_fatality_ratio_pct"),
        m.safe_pct(F.col("total_recovered"), cases).alias("recovery_rate_pct"),
        "max_single_location_cases", "max_single_location_deaths",
        labels.GLOBAL_TIER(F.col("global_rank_cases")).alias("global_impact_tier"),
        labels.FATALITY_CLASS(F.col("avg_case_fatality_ratio_pct")).alias("severity_classification"),
    )
