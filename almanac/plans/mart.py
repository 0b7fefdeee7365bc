"""Marts over the fact: top countries, trends with weekly context, correlations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import labels
from almanac.functions import metrics as m
from almanac.operators.context import with_group_totals
from almanac.operators.correlate import Pair, pair_statistics
from almanac.operators.latest import latest_per_key
from almanac.operators.ranking import top_rows, with_share
from almanac.plans.agg import us_rows
from almanac.sources.stage import stage

TOP_N = 5

PAIRS = [
    Pair(labels.CASES_DEATHS, "confirmed_cases", "total_deaths", ("total_deaths",)),
    Pair(labels.TESTING_INCIDENT, "testing_rate_per_100k", "incident_rate_per_100k",
         ("testing_rate_per_100k", "incident_rate_per_100k")),
    Pair(labels.HOSPITAL_MORTALITY, "hospitalization_rate_pct", "mortality_rate_pct",
         ("hospitalization_rate_pct", "mortality_rate_pct")),
    Pair(labels.NEW_CASES_POSITIVITY, "daily_new_cases", "test_positivity_rate_pct",
         ("daily_new_cases", "test_positivity_rate_pct")),
    Pair(labels.CASES_FATALITY, "confirmed_cases", "case_fatality_ratio_pct", ("case_fatality_ratio_pct",)),
]


def country_snapshot(fact: DataFrame) -> DataFrame:
    """Totals per country over its latest report date."""
    return latest_per_key(fact, "country_region", "report_date").groupBy("country_region").agg(
        F.count_distinct("province_state").alias("provinces_reporting"),
        # one date is left per country
        F.lit(1).cast("bigint").alias("occurrence_frequency"),
        F.sum("confirmed_cases").alias("total_confirmed_cases"),
        F.sum("total_deaths").alias("total_deaths"),
        F.sum("total_recovered").alias("total_recovered"),
        m.round_half_up(F.avg("case_fatality_ratio_pct"), 2).alias("avg_case_fatality_ratio_pct"),
        # largest text, not the worst level
        F.max("severity_category").alias("peak_severity_category"),
    )


def top_snapshot(fact: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n largest countries of the snapshot, ranked, with their share of all countries."""
    countries = stage(country_snapshot(fact), "country_snapshot")
    best = top_rows(countries, "total_confirmed_cases", "country_region", n, "rank_by_cases")
    return with_share(best, "total_confirmed_cases", "pct_of_global_cases", countries)


def top_countries(fact: DataFrame) -> DataFrame:
    return top_snapshot(fact).select(
        "rank_by_cases", "country_region", "occurrence_frequency", "total_confirmed_cases", "total_deaths",
        "total_recovered", "provinces_reporting", "avg_case_fatality_ratio_pct", "pct_of_global_cases",
        "peak_severity_category",
        labels.TOP_TIER(F.col("rank_by_cases")).alias("impact_tier"),
    )


def trends(fact: DataFrame) -> DataFrame:
    new_cases = F.col("daily_new_cases")
    rows = with_group_totals(
        us_rows(fact, "province_state"),
        ["province_state", "report_year", "week_of_year"],
        {
            "weekly_avg_new_cases": m.round_half_up(F.avg(new_cases), 2),
            "weekly_peak_new_cases": F.max(new_cases),
            "weekly_total_new_cases": F.sum(new_cases),
        },
    )
    return rows.select(
        "report_date", "report_year", "report_month", "week_of_year", "day_of_week", "province_state",
        "location_name",
        F.col("confirmed_cases").alias("cumulative_confirmed_cases"),
        F.col("total_deaths").alias("cumulative_deaths"),
        "daily_new_cases", "daily_new_deaths", "pct_change_cases", "pct_change_deaths",
        m.round_half_up(F.col("confirmed_cases_7day_avg"), 2).alias("cases_7day_moving_avg"),
        m.round_half_up(F.col("deaths_7day_avg"), 2).alias("deaths_7day_moving_avg"),
        "weekly_avg_new_cases", "weekly_peak_new_cases", "weekly_total_new_cases",
        m.round_half_up(F.col("test_positivity_rate_pct"), 2).alias("test_positivity_rate_pct"),
        m.round_half_up(F.col("case_fatality_ratio_pct"), 2).alias("case_fatality_ratio_pct"),
        "case_trend", "severity_category",
        labels.TREND_STRENGTH(F.abs("pct_change_cases")).alias("trend_strength"),
    )


def us_pair_statistics(fact: DataFrame) -> DataFrame:
    rows = us_rows(fact, "report_date").filter(F.col("confirmed_cases") > 0)
    return pair_statistics(rows, PAIRS)


def described(r: Column, sample: Column, confidence: labels.Ladder) -> list[Column]:
    return [
        labels.CORRELATION_STRENGTH(F.abs(r)).alias("correlation_strength"),
        labels.correlation_direction(r).alias("correlation_direction"),
        confidence(sample).alias("statistical_confidence"),
    ]


def rounded_statistics() -> list[Column]:
    return [
        F.col("metric_pair"),
        m.round_half_up(F.col("correlation_coefficient"), 4).alias("correlation_coefficient"),
        F.col("sample_size"),
        *[m.round_half_up(F.col(c), 2).alias(c)
          for c in ["metric_1_avg", "metric_2_avg", "metric_1_stddev", "metric_2_stddev"]],
    ]


def correlation_metrics(fact: DataFrame) -> DataFrame:
    r = F.col("correlation_coefficient")
    return us_pair_statistics(fact).select(
        *rounded_statistics(),
        *described(r, F.col("sample_size"), labels.CONFIDENCE_MART),
        m.round_half_up(F.pow(r, 2), 4).alias("r_squared"),
        labels.explanation(F.col("metric_pair"), labels.MART_EXPLANATIONS).alias("interpretation"),
    )
