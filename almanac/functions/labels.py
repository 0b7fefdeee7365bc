"""Labels: threshold ladders, trends, correlation wording."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Ladder(NamedTuple):
    """Labels by threshold; the first step that holds wins, NULL takes the default."""

    steps: Sequence[tuple[float, str]]
    default: str
    ascending: bool = False  # True: step holds when value <= threshold, else value >= threshold

    def __call__(self, value: Column) -> Column:
        chain = F
        for threshold, label in self.steps:
            holds = value <= threshold if self.ascending else value >= threshold
            chain = chain.when(holds, F.lit(label))
        return chain.otherwise(F.lit(self.default))


# Thresholds and label texts that dashboards filter on.
SEVERITY = Ladder(
    [(1_000_000, "Critical"), (500_000, "Very High"), (100_000, "High"), (10_000, "Moderate"), (1_000, "Low")],
    "Very Low",
)
STATE_IMPACT = Ladder(
    [(5, "Top 5 - Critical"), (10, "Top 10 - Severe"), (20, "Top 20 - High"), (30, "Moderate")],
    "Lower Impact",
    ascending=True,
)
GLOBAL_TIER = Ladder(
    [(10, "Top 10 Globally"), (25, "Top 25 Globally"), (50, "Top 50 Globally")], "Other", ascending=True
)
TOP_TIER = Ladder([(1, "Highest"), (3, "Very High"), (5, "High")], "Other", ascending=True)
FATALITY_CLASS = Ladder(
    [(5.0, "Very High Severity"), (3.0, "High Severity"), (2.0, "Moderate Severity"), (1.0, "Low Severity")],
    "Very Low Severity",
)
TREND_STRENGTH = Ladder([(20, "Sharp"), (10, "Moderate"), (5, "Gradual")], "Minimal")
CORRELATION_STRENGTH = Ladder(
    [(0.9, "Very Strong"), (0.7, "Strong"), (0.5, "Moderate"), (0.3, "Weak")], "Very Weak or None"
)
CONFIDENCE = Ladder([(100, "High confidence"), (30, "Medium confidence")], "Low confidence")
CONFIDENCE_MART = Ladder([(1000, "Very High confidence"), *CONFIDENCE.steps], CONFIDENCE.default)

# Names of the correlated pairs and their explanations.
CASES_DEATHS = "Confirmed Cases vs Deaths"
TESTING_INCIDENT = "Testing Rate vs Incident Rate"
HOSPITAL_MORTALITY = "Hospitalization Rate vs Mortality Rate"
NEW_CASES_POSITIVITY = "Daily New Cases vs Test Positivity Rate"
CASES_FATALITY = "Confirmed Cases vs Case Fatality Ratio"
NO_EXPLANATION = "No interpretation available"
MART_EXPLANATIONS = {
    CASES_DEATHS: "Strong positive correlation expected: More cases lead to more deaths, validating disease severity.",
    TESTING_INCIDENT: "Positive correlation: Higher testing rates detect more cases, increasing incident rates.",
    HOSPITAL_MORTALITY: "Positive correlation: Higher hospitalization often indicates more severe cases and outcomes.",
    NEW_CASES_POSITIVITY: "Positive correlation: Surges in new cases often accompanied by higher positivity rates.",
    CASES_FATALITY: "Negative correlation possible: Better testing (more cases) may reveal lower true CFR.",
}
REPORT_EXPLANATIONS = {
    CASES_DEATHS: "Strong positive correlation expected: As cases increase, deaths typically increase proportionally.",
    TESTING_INCIDENT: "Positive correlation: Higher testing rates often detect more cases, increasing incident rates.",
    HOSPITAL_MORTALITY: "Positive correlation: Higher hospitalization rates often correlate with more severe outcomes.",
    CASES_FATALITY: "Negative correlation possible: More cases (better testing) may show lower fatality ratios.",
}


def case_trend(current: Column, previous: Column) -> Column:
    """Direction against the previous row; 'Unknown' when either side is absent."""
    step = F.signum(current - previous)
    return (
        F.when(step > 0, F.lit("Increasing"))
        .when(step < 0, F.lit("Decreasing"))
        .when(step == 0, F.lit("Stable"))
        .otherwise(F.lit("Unknown"))
    )


def total_trend(current: Column, previous: Column) -> Column:
    """Direction of a daily total; the first day counts as 'Stable'."""
    step = F.coalesce(F.signum(current - previous), F.lit(0.0))
    return F.when(step > 0, F.lit("Rising")).when(step < 0, F.lit("Falling")).otherwise(F.lit("Stable"))


def correlation_direction(r: Column) -> Column:
    return F.when(r > 0, F.lit("Positive")).when(r < 0, F.lit("Negative")).otherwise(F.lit("None"))


def explanation(pair: Column, texts: dict[str, str]) -> Column:
    lookup = F.create_map(*[F.lit(item) for entry in texts.items() for item in entry])
    return F.coalesce(F.try_element_at(lookup, pair), F.lit(NO_EXPLANATION))
