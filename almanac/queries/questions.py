"""Questions asked of the built tables, and the plain filters, sorts and limits they use."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import metrics as m
from almanac.operators.latest import rows_of_top_keys
from almanac.plans import adhoc, agg, mart, report, trade
from almanac.plans.fact import FACT_FOLDERS
from almanac.plans.trade import table
from almanac.queries.models import DAILY_SUMMARY, TRENDS, TRENDS_REPORT
from almanac.queries.registry import on_fact, query, rounded
from almanac.sources.stage import root_of

DAY = dt.date(1999, 12, 31)  # a day within every test table
STATE = "NATION_11"


@query("latest_snapshot_scalar", on_fact("""
SELECT country_region, province_state, report_date, confirmed_cases, total_deaths, daily_new_cases, case_trend,
  severity_category FROM fact WHERE report_date = (SELECT MAX(report_date) FROM fact)"""))
def _latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    fact = trade.built_fact(spark, sf)
    return adhoc.latest_snapshot(fact, root_of(fact, FACT_FOLDERS))


@query("location_series", on_fact(f"""
SELECT report_date, confirmed_cases, daily_new_cases, confirmed_cases_7day_avg, case_trend,
  test_positivity_rate_pct FROM fact WHERE province_state = '{STATE}' AND data_source = 'US'"""))
def _location_series(spark: SparkSession, sf: str) -> DataFrame:
    return adhoc.location_series(trade.built_fact(spark, sf), STATE, "US")


@query("top_k_join", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY MAX(o_totalprice) DESC NULLS FIRST, o_custkey LIMIT 5)""")
def _top_k_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows_of_top_keys(orders, "o_custkey", "o_totalprice", 5)


@query("compare_top_countries", on_fact("""
SELECT report_date, country_region, province_state, daily_new_cases, case_trend FROM fact
SEMI JOIN (SELECT country_region FROM fact GROUP BY 1 ORDER BY MAX(confirmed_cases) DESC, 1 LIMIT 3) best
  USING (country_region)"""))
def _compare_top_countries(spark: SparkSession, sf: str) -> DataFrame:
    return adhoc.compare_top_countries(trade.built_fact(spark, sf), 3)


@query("weekly_summary", on_fact(f"""
SELECT report_year, week_of_year, data_source, CAST(SUM(daily_new_cases) AS BIGINT) AS weekly_new_cases,
  {rounded("AVG(test_positivity_rate_pct)", 4)} AS avg_positivity,
  COUNT(DISTINCT location_name) AS locations_reporting FROM fact GROUP BY ALL"""))
def _weekly_summary(spark: SparkSession, sf: str) -> DataFrame:
    weeks = adhoc.weekly_summary(trade.built_fact(spark, sf))
    return weeks.withColumn("avg_positivity", m.round_half_up(F.col("avg_positivity"), 4))


@query("top_values", on_fact("""
SELECT country_region, COUNT(DISTINCT report_date) AS frequency, CAST(SUM(confirmed_cases) AS BIGINT) AS total
FROM fact GROUP BY country_region ORDER BY total DESC, country_region LIMIT 5"""))
def _top_values(spark: SparkSession, sf: str) -> DataFrame:
    return adhoc.top_values(trade.built_fact(spark, sf), "country_region", "report_date", "confirmed_cases")


@query("top_event_types", """
SELECT event_type, COUNT(DISTINCT user_id) AS frequency, CAST(SUM(event_id) AS BIGINT) AS total FROM events
GROUP BY event_type ORDER BY total DESC NULLS FIRST, event_type LIMIT 5""")
def _top_event_types(spark: SparkSession, sf: str) -> DataFrame:
    return adhoc.top_values(table(spark, sf, "events"), "event_type", "user_id", "event_id")


@query("countries_on_date", on_fact(f"""
SELECT country_region, CAST(SUM(confirmed_cases) AS BIGINT) AS total_cases,
  CAST(SUM(total_deaths) AS BIGINT) AS total_deaths, {rounded("AVG(case_fatality_ratio_pct)", 4)} AS avg_cfr
FROM fact WHERE report_date = DATE '{DAY}' GROUP BY country_region"""))
def _countries_on_date(spark: SparkSession, sf: str) -> DataFrame:
    countries = adhoc.countries_on(trade.built_fact(spark, sf), DAY)
    return countries.withColumn("avg_cfr", m.round_half_up(F.col("avg_cfr"), 4))


@query("last_30_days", f"""
SELECT snapshot_date, new_cases_today, cases_7day_rolling_avg, test_positivity_rate_pct, case_trend
FROM ({DAILY_SUMMARY}) ORDER BY snapshot_date DESC LIMIT 30""")
def _last_30_days(spark: SparkSession, sf: str) -> DataFrame:
    return adhoc.last_days(agg.daily_summary(trade.built_fact(spark, sf)))


@query("semi_additive_total", on_fact(f"""
SELECT {rounded("SUM(confirmed_cases_7day_avg)")} AS total_7day_avg FROM fact WHERE report_date = DATE '{DAY}'"""))
def _semi_additive_total(spark: SparkSession, sf: str) -> DataFrame:
    total = adhoc.trailing_mean_total_on(trade.built_fact(spark, sf), DAY)
    return total.select(m.round_half_up(F.col("total_7day_avg"), 2).alias("total_7day_avg"))


@query("mean_ratio", on_fact(f"SELECT {rounded('AVG(case_fatality_ratio_pct)', 6)} AS avg_ratio FROM fact"))
def _mean_ratio(spark: SparkSession, sf: str) -> DataFrame:
    mean = adhoc.mean_ratio(trade.built_fact(spark, sf))
    return mean.select(m.round_half_up(F.col("avg_ratio"), 6).alias("avg_ratio"))


@query("state_day_report", on_fact(f"""
SELECT report_date, province_state, CAST(SUM(confirmed_cases) AS BIGINT) AS cases,
  {rounded("AVG(pct_change_cases)")} AS mean_change, MAX(case_trend) AS trend
FROM fact GROUP BY report_date, province_state"""))
def _state_day_report(spark: SparkSession, sf: str) -> DataFrame:
    return trade.built_fact(spark, sf).groupBy("report_date", "province_state").agg(
        F.sum("confirmed_cases").alias("cases"),
        m.round_half_up(F.avg("pct_change_cases"), 2).alias("mean_change"),
        F.max("case_trend").alias("trend"),
    )


@query("sorted_report", TRENDS_REPORT + "\nORDER BY province_state, snapshot_date")
def _sorted_report(spark: SparkSession, sf: str) -> DataFrame:
    return report.trends_over_time(trade.built_fact(spark, sf)).orderBy("province_state", "snapshot_date")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 10")
def _top_k(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc_nulls_first(), "o_orderkey").limit(10)


@query("filter_source", on_fact("""
SELECT country_region, province_state, report_date, confirmed_cases FROM fact WHERE data_source = 'US'"""))
def _filter_source(spark: SparkSession, sf: str) -> DataFrame:
    return agg.us_rows(trade.built_fact(spark, sf)).select(
        "country_region", "province_state", "report_date", "confirmed_cases"
    )


@query("filter_not_null", on_fact("""
SELECT province_state, report_date, pct_change_cases FROM fact WHERE pct_change_cases IS NOT NULL"""))
def _filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = trade.built_fact(spark, sf).select("province_state", "report_date", "pct_change_cases")
    return rows.filter(F.col("pct_change_cases").isNotNull())


@query("filter_exclude", on_fact("""
SELECT province_state, report_date, iso3_code, country_region FROM fact
WHERE country_region <> 'ASIA' AND iso3_code <> 'GBR'"""))
def _filter_exclude(spark: SparkSession, sf: str) -> DataFrame:
    rows = trade.built_fact(spark, sf).select("province_state", "report_date", "iso3_code", "country_region")
    # rows without a code are dropped by the second condition as well
    return rows.filter(F.col("country_region") != "ASIA").filter(F.col("iso3_code") != "GBR")


CORRELATED = {
    "cases_deaths": ("confirmed_cases", "total_deaths"),
    "testing_incident": ("testing_rate_per_100k", "incident_rate_per_100k"),
}


@query("us_correlations", on_fact(f"""
SELECT {rounded("CASE WHEN NOT isnan(a) THEN a END", 4)} AS cases_deaths,
  {rounded("CASE WHEN NOT isnan(b) THEN b END", 4)} AS testing_incident
FROM (SELECT corr(confirmed_cases, total_deaths) AS a, corr(testing_rate_per_100k, incident_rate_per_100k) AS b
  FROM fact WHERE data_source = 'US')"""))
def _us_correlations(spark: SparkSession, sf: str) -> DataFrame:
    found = adhoc.us_correlations(trade.built_fact(spark, sf), CORRELATED)
    return found.select(*[m.round_half_up(F.col(name), 4).alias(name) for name in CORRELATED])


@query("additive_totals", on_fact("""
SELECT CAST(SUM(confirmed_cases) AS BIGINT) AS total_confirmed_cases,
  CAST(SUM(daily_new_cases) AS BIGINT) AS total_daily_new_cases FROM fact"""))
def _additive_totals(spark: SparkSession, sf: str) -> DataFrame:
    return adhoc.totals(trade.built_fact(spark, sf), "confirmed_cases", "daily_new_cases")


@query("trend_of_state", f"""
SELECT report_date, province_state, cases_7day_moving_avg, case_trend, severity_category
FROM ({TRENDS}) WHERE province_state = '{STATE}' ORDER BY report_date DESC""")
def _trend_of_state(spark: SparkSession, sf: str) -> DataFrame:
    return adhoc.trend_of(mart.trends(trade.built_fact(spark, sf)), STATE)
