"""Reports over the fact: top countries, state by day, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions import labels
from almanac.functions import metrics as m
from almanac.plans.agg import us_rows
from almanac.plans.mart import described, rounded_statistics, top_snapshot, us_pair_statistics


def top_countries_by_cases(fact: DataFrame) -> DataFrame:
    return top_snapshot(fact.filter(F.col("country_region") != "Unknown")).select(
        "rank_by_cases", "country_region", "occurrence_frequency", "total_confirmed_cases", "total_deaths",
        "total_recovered", "avg_case_fatality_ratio_pct",
        F.col("provinces_reporting").alias("unique_provinces"),
        "pct_of_global_cases",
        labels.TOP_TIER(F.col("rank_by_cases")).alias("severity_tier"),
    )


def trends_over_time(fact: DataFrame) -> DataFrame:
    """US totals, changes and mean rates per state and day."""
    sums = {"confirmed_cases": "daily_confirmed_cases", "total_deaths": "daily_deaths",
            "people_tested": "daily_people_tested", "people_hospitalized": "daily_people_hospitalized",
            "daily_new_cases": "new_cases_vs_prev_day", "daily_new_deaths": "new_deaths_vs_prev_day"}
    means = {"pct_change_cases": "pct_change_cases", "pct_change_deaths": "pct_change_deaths",
             "confirmed_cases_7day_avg": "cases_7day_moving_avg", "deaths_7day_avg": "deaths_7day_moving_avg",
             "testing_rate_per_100k": "avg_testing_rate_per_100k",
             "hospitalization_rate_pct": "avg_hospitalization_rate_pct",
             "mortality_rate_pct": "avg_mortality_rate_pct",
             "incident_rate_per_100k": "avg_incident_rate_per_100k"}
    rows = us_rows(fact, "report_date", "province_state")
    return rows.groupBy(F.col("report_date").alias("snapshot_date"), "province_state").agg(
        *[F.sum(c).alias(name) for c, name in sums.items()],
        *[m.round_half_up(F.avg(c), 2).alias(name) for c, name in means.items()],
        # largest text of the day's trends
        F.max("case_trend").alias("trend_direction"),
    )


def correlation_analysis(fact: DataFrame) -> DataFrame:
    r = F.col("correlation_coefficient")
    return us_pair_statistics(fact).select(
        *rounded_statistics(),
        *described(r, F.col("sample_size"), labels.CONFIDENCE),
        labels.explanation(F.col("metric_pair"), labels.REPORT_EXPLANATIONS).alias("interpretation"),
    )
