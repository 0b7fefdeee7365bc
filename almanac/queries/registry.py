"""Where queries and their check SQL are registered, and the SQL texts several checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from almanac.queries import expected
from almanac.queries.expected import ladder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = build
        ORACLES[name] = sql
        return build

    return register


def rounded(expr: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {rounded(f'1e2 * ({part}) / ({whole})')} END"


def total(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


CELLS = f"""
cells AS (
  SELECT n_nationkey, n_name, r_name, CAST(o_orderdate AS DATE) AS day,
    {total("CAST(l_quantity AS BIGINT)")} AS all_units,
    {total("CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END")} AS r_units,
    {total("CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END")} AS a_units,
    {total("CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0 END")} AS n_units,
    COUNT(*) AS lines,
    COUNT(*) FILTER (WHERE l_returnflag = 'A') AS a_lines,
    {total("CAST(floor(l_discount * 100 + 0.5e0) AS BIGINT)")} AS discount,
    {total("CAST(floor(l_tax * 100 + 0.5e0) AS BIGINT)")} AS tax
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL
)"""

REPORTS = f"""{CELLS},
all_reports AS (
  SELECT
    CASE WHEN r_name = 'AMERICA' THEN 'US' ELSE 'Global' END AS data_source,
    r_name AS country_region, n_name AS province_state, CAST(NULL AS VARCHAR) AS admin2,
    CAST(n_nationkey AS BIGINT) AS fips_code,
    CASE WHEN r_name = 'AMERICA' THEN 'USA' END AS iso3_code,
    CASE WHEN r_name = 'AMERICA' THEN 84000000 + CAST(n_nationkey AS BIGINT) END AS uid,
    day AS report_date,
    CASE WHEN n_nationkey <> 0 THEN CAST(n_nationkey AS DOUBLE) END AS latitude,
    CASE WHEN n_nationkey <> 0 THEN -CAST(n_nationkey AS DOUBLE) END AS longitude,
    CAST(COALESCE(SUM(all_units) OVER so_far, 0) AS BIGINT) AS confirmed_cases,
    CAST(COALESCE(SUM(r_units) OVER so_far, 0) AS BIGINT) AS total_deaths,
    CAST(COALESCE(SUM(a_units) OVER so_far, 0) AS BIGINT) AS total_recovered,
    CAST(COALESCE(SUM(n_units) OVER so_far, 0) AS BIGINT) AS active_cases,
    CASE WHEN r_name = 'AMERICA' THEN CAST(SUM(lines) OVER so_far AS BIGINT) END AS total_test_results,
    CASE WHEN r_name = 'AMERICA' THEN CAST(20 * SUM(lines) OVER so_far AS BIGINT) END AS people_tested,
    CASE WHEN r_name = 'AMERICA' THEN CAST(SUM(a_lines) OVER so_far AS BIGINT) END AS people_hospitalized,
    CAST(discount AS DOUBLE) / lines AS incident_rate_per_100k,
    1e2 * r_units / all_units AS case_fatality_ratio_pct,
    CASE WHEN r_name = 'AMERICA' THEN CAST(tax AS DOUBLE) / lines END AS testing_rate_per_100k,
    CASE WHEN r_name = 'AMERICA' THEN 1e2 * a_lines / lines END AS hospitalization_rate_pct,
    CASE WHEN r_name = 'AMERICA' THEN 1e2 * n_units / all_units END AS mortality_rate_pct,
    'bronze.orders_' || strftime(day, '%m_%d_%Y') AS _source_table
  FROM cells
  WINDOW so_far AS (PARTITION BY n_nationkey ORDER BY day NULLS LAST)
),
reports AS (SELECT * FROM all_reports WHERE data_source <> 'US' OR report_date IS NOT NULL)"""

FACT = f"""{REPORTS},
compared AS (
  SELECT *,
    LAG(confirmed_cases) OVER by_day AS prev_cases,
    LAG(total_deaths) OVER by_day AS prev_deaths,
    LAG(people_tested) OVER by_day AS prev_tested,
    AVG(confirmed_cases) OVER seven AS mean_cases,
    AVG(total_deaths) OVER seven AS mean_deaths
  FROM reports
  WINDOW by_day AS (PARTITION BY country_region, province_state ORDER BY report_date NULLS LAST),
    seven AS (PARTITION BY country_region, province_state ORDER BY report_date NULLS LAST
              ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
),
fact AS (
  SELECT
    md5(data_source || '-' || country_region || '-' || province_state || '-' || '' || '-'
        || COALESCE(CAST(report_date AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS fact_key,
    data_source, country_region, province_state, admin2,
    province_state || ', ' || country_region AS location_name,
    fips_code, iso3_code, uid, report_date,
    year(report_date) AS report_year, month(report_date) AS report_month, day(report_date) AS report_day,
    rpad(dayname(report_date), 9, ' ') AS day_of_week, weekofyear(report_date) AS week_of_year,
    latitude, longitude, confirmed_cases, total_deaths, total_recovered, active_cases,
    total_test_results, people_tested, people_hospitalized,
    COALESCE(confirmed_cases - prev_cases, 0) AS daily_new_cases,
    COALESCE(total_deaths - prev_deaths, 0) AS daily_new_deaths,
    COALESCE(people_tested - prev_tested, 0) AS daily_new_tests,
    {pct("confirmed_cases - prev_cases", "prev_cases")} AS pct_change_cases,
    {pct("total_deaths - prev_deaths", "prev_deaths")} AS pct_change_deaths,
    {rounded("mean_cases")} AS confirmed_cases_7day_avg,
    {rounded("mean_deaths")} AS deaths_7day_avg,
    incident_rate_per_100k, testing_rate_per_100k, case_fatality_ratio_pct,
    hospitalization_rate_pct, mortality_rate_pct,
    {pct("total_deaths", "confirmed_cases")} AS calculated_cfr_pct,
    {pct("total_recovered", "confirmed_cases")} AS recovery_rate_pct,
    {pct("confirmed_cases", "people_tested")} AS test_positivity_rate_pct,
    {pct("people_hospitalized", "confirmed_cases")} AS hospitalization_to_case_ratio_pct,
    COALESCE(confirmed_cases > prev_cases, FALSE) AS has_new_cases,
    COALESCE(total_deaths > prev_deaths, FALSE) AS has_new_deaths,
    CASE sign(confirmed_cases - prev_cases)
      WHEN 1 THEN 'Increasing' WHEN -1 THEN 'Decreasing' WHEN 0 THEN 'Stable' ELSE 'Unknown' END AS case_trend,
    {ladder("confirmed_cases", expected.SEVERITY)} AS severity_category,
    CAST(report_date AS TIMESTAMP) AS last_updated_at, _source_table
  FROM compared
)"""


def on_fact(select: str, *more: str) -> str:
    """SQL that reads the fact; `more` are further common table expressions."""
    return f"WITH {','.join([FACT, *more])}\n{select}"


def on_reports(select: str, *more: str) -> str:
    return f"WITH {','.join([REPORTS, *more])}\n{select}"
