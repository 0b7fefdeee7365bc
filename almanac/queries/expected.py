"""What the check SQL expects, written out. Nothing here is taken from the code that is checked."""

from __future__ import annotations

# Thresholds and label texts, first step that holds; then the text where none does.
SEVERITY = (">=", [(1000000, "Critical"), (500000, "Very High"), (100000, "High"), (10000, "Moderate"), (1000, "Low")], "Very Low")
STATE_IMPACT = ("<=", [(5, "Top 5 - Critical"), (10, "Top 10 - Severe"), (20, "Top 20 - High"), (30, "Moderate")], "Lower Impact")
GLOBAL_TIER = ("<=", [(10, "Top 10 Globally"), (25, "Top 25 Globally"), (50, "Top 50 Globally")], "Other")
TOP_TIER = ("<=", [(1, "Highest"), (3, "Very High"), (5, "High")], "Other")
FATALITY_CLASS = (
    ">=", [(5.0, "Very High Severity"), (3.0, "High Severity"), (2.0, "Moderate Severity"), (1.0, "Low Severity")], "Very Low Severity")
TREND_STRENGTH = (">=", [(20, "Sharp"), (10, "Moderate"), (5, "Gradual")], "Minimal")
CORRELATION_STRENGTH = (">=", [(0.9, "Very Strong"), (0.7, "Strong"), (0.5, "Moderate"), (0.3, "Weak")], "Very Weak or None")
CONFIDENCE = (">=", [(100, "High confidence"), (30, "Medium confidence")], "Low confidence")
CONFIDENCE_MART = (">=", [(1000, "Very High confidence"), (100, "High confidence"), (30, "Medium confidence")], "Low confidence")

# Mean rates of the summaries, correlated pairs and their explanations.
RATES = ["incident_rate_per_100k", "case_fatality_ratio_pct", "testing_rate_per_100k", "hospitalization_rate_pct", "mortality_rate_pct"]
PAIRS = [
    ("Confirmed Cases vs Deaths", "confirmed_cases", "total_deaths"),
    ("Testing Rate vs Incident Rate", "testing_rate_per_100k", "incident_rate_per_100k"),
    ("Hospitalization Rate vs Mortality Rate", "hospitalization_rate_pct", "mortality_rate_pct"),
    ("Daily New Cases vs Test Positivity Rate", "daily_new_cases", "test_positivity_rate_pct"),
    ("Confirmed Cases vs Case Fatality Ratio", "confirmed_cases", "case_fatality_ratio_pct"),
]
UNEXPLAINED = "No interpretation available"
MART_EXPLANATIONS = {
    "Confirmed Cases vs Deaths":
        "Strong positive correlation expected: More cases lead to more deaths, validating disease severity.",
    "Testing Rate vs Incident Rate":
        "Positive correlation: Higher testing rates detect more cases, increasing incident rates.",
    "Hospitalization Rate vs Mortality Rate":
        "Positive correlation: Higher hospitalization often indicates more severe cases and outcomes.",
    "Daily New Cases vs Test Positivity Rate":
        "Positive correlation: Surges in new cases often accompanied by higher positivity rates.",
    "Confirmed Cases vs Case Fatality Ratio":
        "Negative correlation possible: Better testing (more cases) may reveal lower true CFR.",
}
REPORT_EXPLANATIONS = {
    "Confirmed Cases vs Deaths":
        "Strong positive correlation expected: As cases increase, deaths typically increase proportionally.",
    "Testing Rate vs Incident Rate":
        "Positive correlation: Higher testing rates often detect more cases, increasing incident rates.",
    "Hospitalization Rate vs Mortality Rate":
        "Positive correlation: Higher hospitalization rates often correlate with more severe outcomes.",
    "Confirmed Cases vs Case Fatality Ratio":
        "Negative correlation possible: More cases (better testing) may show lower fatality ratios.",
}


def ladder(value: str, steps: tuple) -> str:
    compare, thresholds, default = steps
    whens = " ".join(f"WHEN {value} {compare} {t} THEN '{label}'" for t, label in thresholds)
    return f"CASE {whens} ELSE '{default}' END"

# Which columns of which published table are tested; written out apart from the tests that run.
TESTS = {
    "fct_covid_daily": [
        ("fact_key", "not_null", ()),
        ("fact_key", "unique", ()),
        ("data_source", "not_null", ()),
        ("data_source", "accepted_values", ("US", "Global")),
        ("country_region", "not_null", ()),
        ("location_name", "not_null", ()),
        ("report_date", "not_null", ()),
        ("confirmed_cases", "not_null", ()),
        ("case_trend", "accepted_values", ("Increasing", "Decreasing", "Stable", "Unknown")),
        ("severity_category", "accepted_values", ("Critical", "Very High", "High", "Moderate", "Low", "Very Low")),
        ("_fact_created_at", "not_null", ()),
    ],
    "rpt_top_countries_by_cases": [
        ("rank_by_cases", "not_null", ()),
        ("rank_by_cases", "accepted_values", (1, 2, 3, 4, 5)),
        ("country_region", "not_null", ()),
        ("country_region", "unique", ()),
        ("occurrence_frequency", "not_null", ()),
        ("total_confirmed_cases", "not_null", ()),
    ],
    "rpt_covid_trends_over_time": [
        ("snapshot_date", "not_null", ()),
        ("province_state", "not_null", ()),
        ("trend_direction", "accepted_values", ("Increasing", "Decreasing", "Stable", "Unknown")),
    ],
    "rpt_correlation_analysis": [
        ("metric_pair", "not_null", ()),
        ("metric_pair", "unique", ()),
        ("correlation_coefficient", "not_null", ()),
        ("sample_size", "not_null", ()),
        ("correlation_strength", "accepted_values", ("Very Strong", "Strong", "Moderate", "Weak", "Very Weak or None")),
        ("correlation_direction", "accepted_values", ("Positive", "Negative", "None")),
        ("statistical_confidence", "accepted_values", ("High confidence", "Medium confidence", "Low confidence")),
    ],
    "agg_daily_summary": [
        ("snapshot_date", "not_null", ()),
        ("snapshot_date", "unique", ()),
    ],
    "agg_state_summary": [
        ("province_state", "not_null", ()),
        ("province_state", "unique", ()),
        ("impact_category", "accepted_values", ("Top 5 - Critical", "Top 10 - Severe", "Top 20 - High", "Moderate", "Lower Impact")),
    ],
    "agg_country_summary": [
        ("country_region", "not_null", ()),
        ("country_region", "unique", ()),
        ("global_impact_tier", "accepted_values", ("Top 10 Globally", "Top 25 Globally", "Top 50 Globally", "Other")),
        ("severity_classification", "accepted_values", ("Very High Severity", "High Severity", "Moderate Severity", "Low Severity", "Very Low Severity")),
    ],
    "mart_top_countries": [
        ("rank_by_cases", "not_null", ()),
        ("country_region", "not_null", ()),
    ],
    "mart_covid_trends": [
        ("report_date", "not_null", ()),
    ],
    "mart_correlation_metrics": [
        ("metric_pair", "not_null", ()),
        ("correlation_coefficient", "not_null", ()),
    ],
}
