"""The declared column tests of the published tables."""

from __future__ import annotations

from almanac.operators.quality import ColumnTest, accepted, not_null, unique


_TRENDS = ("Increasing", "Decreasing", "Stable", "Unknown")

# Which columns of which published table are tested, and how.
MODEL_TESTS: dict[str, list[ColumnTest]] = {
    "fct_covid_daily": [
        not_null("fact_key"),
        unique("fact_key"),
        not_null("data_source"),
        accepted("data_source", "US", "Global"),
        not_null("country_region"),
        not_null("location_name"),
        not_null("report_date"),
        not_null("confirmed_cases"),
        accepted("case_trend", *_TRENDS),
        accepted("severity_category", "Critical", "Very High", "High", "Moderate", "Low", "Very Low"),
        not_null("_fact_created_at"),
    ],
    "rpt_top_countries_by_cases": [
        not_null("rank_by_cases"),
        accepted("rank_by_cases", 1, 2, 3, 4, 5),
        not_null("country_region"),
        unique("country_region"),
        not_null("occurrence_frequency"),
        not_null("total_confirmed_cases"),
    ],
    "rpt_covid_trends_over_time": [
        not_null("snapshot_date"),
        not_null("province_state"),
        accepted("trend_direction", *_TRENDS),
    ],
    "rpt_correlation_analysis": [
        not_null("metric_pair"),
        unique("metric_pair"),
        not_null("correlation_coefficient"),
        not_null("sample_size"),
        accepted("correlation_strength", "Very Strong", "Strong", "Moderate", "Weak", "Very Weak or None"),
        accepted("correlation_direction", "Positive", "Negative", "None"),
        accepted("statistical_confidence", "High confidence", "Medium confidence", "Low confidence"),
    ],
    "agg_daily_summary": [not_null("snapshot_date"), unique("snapshot_date")],
    "agg_state_summary": [
        not_null("province_state"),
        unique("province_state"),
        accepted("impact_category", "Top 5 - Critical", "Top 10 - Severe", "Top 20 - High", "Moderate", "Lower Impact"),
    ],
    "agg_country_summary": [
        not_null("country_region"),
        unique("country_region"),
        accepted("global_impact_tier", "Top 10 Globally", "Top 25 Globally", "Top 50 Globally", "Other"),
        accepted(
            "severity_classification", "Very High Severity", "High Severity", "Moderate Severity", "Low Severity", "Very Low Severity",
        ),
    ],
    "mart_top_countries": [not_null("rank_by_cases"), not_null("country_region")],
    "mart_covid_trends": [not_null("report_date")],
    "mart_correlation_metrics": [not_null("metric_pair"), not_null("correlation_coefficient")],
}
