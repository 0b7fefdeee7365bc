"""The aggregates, marts and reports over the built fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from almanac.plans import agg, mart, report, trade
from almanac.queries import expected
from almanac.queries.registry import ladder, on_fact, pct, query, rounded


def _over_fact(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: build(trade.built_fact(spark, sf))


MEAN_RATES = ",\n  ".join(f"{rounded(f'AVG({r})')} AS avg_{r}" for r in expected.RATES)

DAYS = f"""
days AS (
  SELECT report_date AS snapshot_date, CAST(SUM(confirmed_cases) AS BIGINT) AS cases,
    CAST(SUM(total_deaths) AS BIGINT) AS deaths, CAST(SUM(total_recovered) AS BIGINT) AS total_recovered,
    CAST(SUM(active_cases) AS BIGINT) AS total_active_cases,
    CAST(SUM(people_tested) AS BIGINT) AS total_people_tested,
    CAST(SUM(people_hospitalized) AS BIGINT) AS total_people_hospitalized,
    {MEAN_RATES}, COUNT(DISTINCT province_state) AS states_reporting
  FROM fact WHERE data_source = 'US' AND report_date IS NOT NULL GROUP BY report_date
)"""

DAILY_SUMMARY = on_fact(f"""
SELECT * EXCLUDE (cases, deaths), cases AS total_confirmed_cases, deaths AS total_deaths,
  COALESCE(cases - LAG(cases) OVER w, 0) AS new_cases_today,
  COALESCE(deaths - LAG(deaths) OVER w, 0) AS new_deaths_today,
  {rounded("AVG(cases) OVER seven")} AS cases_7day_rolling_avg,
  {rounded("AVG(deaths) OVER seven")} AS deaths_7day_rolling_avg,
  {pct("deaths", "cases")} AS overall_case_fatality_ratio_pct,
  {pct("cases", "total_people_tested")} AS test_positivity_rate_pct,
  CASE sign(cases - LAG(cases) OVER w) WHEN 1 THEN 'Rising' WHEN -1 THEN 'Falling' ELSE 'Stable' END AS case_trend
FROM days
WINDOW w AS (ORDER BY snapshot_date), seven AS (ORDER BY snapshot_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""", DAYS)

STATES = """
states AS (
  SELECT province_state, COUNT(DISTINCT report_date) AS days_reporting, MAX(report_date) AS latest_report_date,
    MAX(confirmed_cases) AS cases, MAX(total_deaths) AS deaths, MAX(total_recovered) AS total_recovered,
    MAX(people_tested) AS total_people_tested, MAX(people_hospitalized) AS total_people_hospitalized,
    AVG(incident_rate_per_100k) AS r1, AVG(case_fatality_ratio_pct) AS r2, AVG(testing_rate_per_100k) AS r3,
    AVG(hospitalization_rate_pct) AS r4, AVG(mortality_rate_pct) AS r5
  FROM fact WHERE data_source = 'US' AND province_state IS NOT NULL GROUP BY ALL
),
ranked_states AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY cases DESC NULLS FIRST, province_state) AS by_cases,
    ROW_NUMBER() OVER (ORDER BY deaths DESC NULLS FIRST, province_state) AS by_deaths,
    ROW_NUMBER() OVER (ORDER BY r1 DESC NULLS FIRST, province_state) AS by_incidents,
    PERCENT_RANK() OVER (ORDER BY cases) AS p_cases, PERCENT_RANK() OVER (ORDER BY deaths) AS p_deaths
  FROM states
)"""

STATE_SUMMARY = on_fact(f"""
SELECT province_state, days_reporting, latest_report_date, cases AS total_confirmed_cases,
  deaths AS total_deaths, total_recovered, total_people_tested, total_people_hospitalized,
  by_cases AS national_rank_cases, by_deaths AS national_rank_deaths,
  by_incidents AS national_rank_incident_rate,
  {rounded("p_cases", 4)} AS cases_percentile, {rounded("p_deaths", 4)} AS deaths_percentile,
  {', '.join(f'{rounded(f"r{i + 1}")} AS avg_{rate}' for i, rate in enumerate(expected.RATES))},
  {pct("deaths", "cases")} AS overall_case_fatality_ratio_pct,
  {pct("cases", "total_people_tested")} AS test_positivity_rate_pct,
  cases AS peak_confirmed_cases, deaths AS peak_deaths,
  {ladder("by_cases", expected.STATE_IMPACT)} AS impact_category
FROM ranked_states""", STATES)

COUNTRIES = """
countries AS (
  SELECT country_region, COUNT(*) AS data_points, COUNT(DISTINCT province_state) AS provinces_reporting,
    COUNT(DISTINCT location_name) AS unique_locations, CAST(SUM(confirmed_cases) AS BIGINT) AS cases,
    CAST(SUM(total_deaths) AS BIGINT) AS deaths, CAST(SUM(total_recovered) AS BIGINT) AS recovered,
    CAST(SUM(active_cases) AS BIGINT) AS total_active_cases,
    AVG(incident_rate_per_100k) AS r1, AVG(case_fatality_ratio_pct) AS r2,
    MAX(confirmed_cases) AS max_single_location_cases, MAX(total_deaths) AS max_single_location_deaths
  FROM fact WHERE country_region <> 'Unknown' GROUP BY country_region
),
ranked_countries AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY cases DESC, country_region) AS by_cases,
    ROW_NUMBER() OVER (ORDER BY deaths DESC, country_region) AS by_deaths,
    ROW_NUMBER() OVER (ORDER BY recovered DESC, country_region) AS by_recovered
  FROM countries
)"""

COUNTRY_SUMMARY = on_fact(f"""
SELECT country_region, data_points, provinces_reporting, unique_locations, cases AS total_confirmed_cases,
  deaths AS total_deaths, recovered AS total_recovered, total_active_cases,
  by_cases AS global_rank_cases, by_deaths AS global_rank_deaths, by_recovered AS global_rank_recovered,
  {rounded("1e2 * cases / (SELECT SUM(cases) FROM countries)")} AS pct_of_global_cases,
  {rounded("1e2 * deaths / (SELECT SUM(deaths) FROM countries)")} AS pct_of_global_deaths,
  {rounded("r1")} AS avg_incident_rate_per_100k, {rounded("r2")} AS avg_case_fatality_ratio_pct,
  {pct("deaths", "cases")} AS overall_case_fatality_ratio_pct, {pct("recovered", "cases")} AS recovery_rate_pct,
  max_single_location_cases, max_single_location_deaths,
  {ladder("by_cases", expected.GLOBAL_TIER)} AS global_impact_tier,
  {ladder("r2", expected.FATALITY_CLASS)} AS severity_classification
FROM ranked_countries""", COUNTRIES)

SNAPSHOT = f"""
snapshot AS (
  SELECT country_region, COUNT(DISTINCT report_date) AS occurrence_frequency,
    CAST(SUM(confirmed_cases) AS BIGINT) AS cases, CAST(SUM(total_deaths) AS BIGINT) AS total_deaths,
    CAST(SUM(total_recovered) AS BIGINT) AS total_recovered, COUNT(DISTINCT province_state) AS provinces,
    {rounded("AVG(case_fatality_ratio_pct)")} AS avg_case_fatality_ratio_pct,
    MAX(severity_category) AS peak_severity_category
  FROM fact JOIN (SELECT country_region, MAX(report_date) AS report_date FROM fact GROUP BY country_region) newest
    USING (country_region, report_date)
  WHERE country_region <> 'Unknown'
  GROUP BY country_region
),
best AS (
  SELECT *, cases AS total_confirmed_cases,
    {rounded("1e2 * cases / (SELECT SUM(cases) FROM snapshot)")} AS pct_of_global_cases,
    ROW_NUMBER() OVER (ORDER BY cases DESC NULLS FIRST, country_region) AS rank_by_cases
  FROM snapshot
)"""
_BEST = """rank_by_cases, country_region, occurrence_frequency, total_confirmed_cases, total_deaths, total_recovered,
  avg_case_fatality_ratio_pct, pct_of_global_cases"""

TOP_COUNTRIES = on_fact(f"""
SELECT {_BEST}, provinces AS provinces_reporting, peak_severity_category,
  {ladder("rank_by_cases", expected.TOP_TIER)} AS impact_tier
FROM best WHERE rank_by_cases <= 5""", SNAPSHOT)

TOP_COUNTRIES_REPORT = on_fact(f"""
SELECT {_BEST}, provinces AS unique_provinces, {ladder("rank_by_cases", expected.TOP_TIER)} AS severity_tier
FROM best WHERE rank_by_cases <= 5""", SNAPSHOT)

TRENDS = on_fact(f"""
SELECT report_date, report_year, report_month, week_of_year, day_of_week, province_state, location_name,
  confirmed_cases AS cumulative_confirmed_cases, total_deaths AS cumulative_deaths, daily_new_cases,
  daily_new_deaths, pct_change_cases, pct_change_deaths,
  {rounded("confirmed_cases_7day_avg")} AS cases_7day_moving_avg,
  {rounded("deaths_7day_avg")} AS deaths_7day_moving_avg,
  {rounded("AVG(daily_new_cases) OVER week")} AS weekly_avg_new_cases,
  MAX(daily_new_cases) OVER week AS weekly_peak_new_cases,
  CAST(SUM(daily_new_cases) OVER week AS BIGINT) AS weekly_total_new_cases,
  {rounded("test_positivity_rate_pct")} AS test_positivity_rate_pct,
  {rounded("case_fatality_ratio_pct")} AS case_fatality_ratio_pct,
  case_trend, severity_category, {ladder("abs(pct_change_cases)", expected.TREND_STRENGTH)} AS trend_strength
FROM fact WHERE data_source = 'US' AND province_state IS NOT NULL
WINDOW week AS (PARTITION BY province_state, report_year, week_of_year)""")

_REPORT_SUMS = {
    "confirmed_cases": "daily_confirmed_cases", "total_deaths": "daily_deaths",
    "people_tested": "daily_people_tested", "people_hospitalized": "daily_people_hospitalized",
    "daily_new_cases": "new_cases_vs_prev_day", "daily_new_deaths": "new_deaths_vs_prev_day",
}
_REPORT_MEANS = {
    "pct_change_cases": "pct_change_cases", "pct_change_deaths": "pct_change_deaths",
    "confirmed_cases_7day_avg": "cases_7day_moving_avg", "deaths_7day_avg": "deaths_7day_moving_avg",
    "testing_rate_per_100k": "avg_testing_rate_per_100k",
    "hospitalization_rate_pct": "avg_hospitalization_rate_pct",
    "mortality_rate_pct": "avg_mortality_rate_pct", "incident_rate_per_100k": "avg_incident_rate_per_100k",
}
TRENDS_REPORT = on_fact(f"""
SELECT report_date AS snapshot_date, province_state,
  {', '.join(f'CAST(SUM({c}) AS BIGINT) AS {name}' for c, name in _REPORT_SUMS.items())},
  {', '.join(f'{rounded(f"AVG(f.{c})")} AS {name}' for c, name in _REPORT_MEANS.items())},
  MAX(case_trend) AS trend_direction
FROM fact f WHERE data_source = 'US' AND report_date IS NOT NULL AND province_state IS NOT NULL
GROUP BY 1, 2""")


def _pair_sql(name: str, x: str, y: str) -> str:
    return f"""SELECT '{name}' AS metric_pair, corr({x}, {y}) AS r, COUNT(*) AS sample_size, AVG({x}) AS a1,
    AVG({y}) AS a2, stddev_samp({x}) AS s1, stddev_samp({y}) AS s2
  FROM us WHERE {x} IS NOT NULL AND {y} IS NOT NULL"""


PAIR_STATISTICS = f"""
us AS (SELECT * FROM fact WHERE data_source = 'US' AND confirmed_cases > 0),
raw_pairs AS ({' UNION ALL '.join(_pair_sql(*pair) for pair in expected.PAIRS)}),
pairs AS (SELECT * REPLACE (CASE WHEN NOT isnan(r) THEN r END AS r) FROM raw_pairs)"""
_PAIR_COLUMNS = f"""metric_pair, {rounded("r", 4)} AS correlation_coefficient, sample_size,
  {rounded("a1")} AS metric_1_avg, {rounded("a2")} AS metric_2_avg,
  {rounded("s1")} AS metric_1_stddev, {rounded("s2")} AS metric_2_stddev"""
_PAIR_LABELS = f"""{ladder("abs(r)", expected.CORRELATION_STRENGTH)} AS correlation_strength,
  CASE sign(r) WHEN 1 THEN 'Positive' WHEN -1 THEN 'Negative' ELSE 'None' END AS correlation_direction"""


def _explained(texts: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{pair}' THEN '{text}'" for pair, text in texts.items())
    return f"CASE metric_pair {whens} ELSE '{expected.UNEXPLAINED}' END AS interpretation"


CORRELATION_MART = on_fact(f"""
SELECT {_PAIR_COLUMNS}, {_PAIR_LABELS},
  {ladder("sample_size", expected.CONFIDENCE_MART)} AS statistical_confidence,
  {rounded("r * r", 4)} AS r_squared, {_explained(expected.MART_EXPLANATIONS)} FROM pairs""", PAIR_STATISTICS)
CORRELATION_REPORT = on_fact(f"""
SELECT {_PAIR_COLUMNS}, {_PAIR_LABELS},
  {ladder("sample_size", expected.CONFIDENCE)} AS statistical_confidence,
  {_explained(expected.REPORT_EXPLANATIONS)} FROM pairs""", PAIR_STATISTICS)

query("agg_daily_summary", DAILY_SUMMARY)(_over_fact(agg.daily_summary))
query("agg_state_summary", STATE_SUMMARY)(_over_fact(agg.state_summary))
query("agg_country_summary", COUNTRY_SUMMARY)(_over_fact(agg.country_summary))
query("mart_top_countries", TOP_COUNTRIES)(_over_fact(mart.top_countries))
query("mart_trends", TRENDS)(_over_fact(mart.trends))
query("mart_correlation", CORRELATION_MART)(_over_fact(mart.correlation_metrics))
query("rpt_top_countries", TOP_COUNTRIES_REPORT)(_over_fact(report.top_countries_by_cases))
query("rpt_trends", TRENDS_REPORT)(_over_fact(report.trends_over_time))
query("rpt_correlation", CORRELATION_REPORT)(_over_fact(report.correlation_analysis))
