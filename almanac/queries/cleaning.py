"""Cell cleaning, drifting unions and the cleaned tables, over the whole input tables.

The input tables hold no bad cells, so both sides first spoil some with the same rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import clean
from almanac.functions import metrics as m
from almanac.operators.union import union_drifting
from almanac.plans import fact as fact_plan
from almanac.plans import silver, trade
from almanac.plans.trade import table
from almanac.queries.registry import CELLS, on_reports, query, rounded

SPOILT_TEXT = """CASE c_custkey % 6 WHEN 0 THEN '   ' WHEN 1 THEN '' WHEN 2 THEN concat('  ', c_mktsegment, ' ')
  WHEN 3 THEN NULL ELSE c_mktsegment END"""
SPOILT_NUMBER = """CASE c_custkey % 7 WHEN 0 THEN 0e0 WHEN 1 THEN -1e0 WHEN 2 THEN NULL WHEN 3 THEN 1e2
  WHEN 4 THEN 100.1e0 ELSE c_acctbal / 8e1 END"""


@query("clean_text", f"SELECT c_custkey, NULLIF(TRIM({SPOILT_TEXT}), '') AS segment FROM customer")
def _clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", clean.clean_text(F.expr(SPOILT_TEXT)).alias("segment")
    )


@query("clean_text_default",
       f"SELECT c_custkey, COALESCE(NULLIF(TRIM({SPOILT_TEXT}), ''), 'Unknown') AS segment FROM customer")
def _clean_text_default(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", clean.clean_text_or(F.expr(SPOILT_TEXT), "Unknown").alias("segment")
    )


@query("zero_to_null", f"SELECT c_custkey, NULLIF({SPOILT_NUMBER}, 0) AS latitude FROM customer")
def _zero_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", clean.zero_to_null(F.expr(SPOILT_NUMBER)).alias("latitude")
    )


@query("null_to_zero", f"SELECT c_custkey, COALESCE({SPOILT_NUMBER}, 0) AS amount FROM customer")
def _null_to_zero(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", clean.null_to_zero(F.expr(SPOILT_NUMBER)).alias("amount")
    )


@query("range_guard_low", f"""SELECT c_custkey, CASE WHEN v >= 0 THEN v END AS rate
FROM (SELECT c_custkey, {SPOILT_NUMBER} AS v FROM customer)""")
def _range_guard_low(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", clean.not_below_zero(F.expr(SPOILT_NUMBER)).alias("rate")
    )


@query("range_guard_pct", f"""SELECT c_custkey, CASE WHEN NOT (v < 0 OR v > 100) THEN v END AS rate_pct
FROM (SELECT c_custkey, {SPOILT_NUMBER} AS v FROM customer)""")
def _range_guard_pct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", clean.within_percent(F.expr(SPOILT_NUMBER)).alias("rate_pct")
    )


def _written_times(events: DataFrame) -> DataFrame:
    """Each event's time as text, in the layouts that reports use over the years."""
    ts = F.col("ts")
    layout = F.col("event_id") % 5
    return events.select(
        "event_id", "ts",
        F.when(layout == 0, F.date_format(ts, "M/d/yyyy H:mm"))
        .when(layout == 1, F.date_format(ts, "M/d/yy H:mm"))
        .when(layout == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(layout == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("written"),
    )


@query("parse_timestamp_utc", """
SELECT event_id, CASE event_id % 5
    WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:00') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:00')
    WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS updated_at
FROM events""")
def _parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    parsed = clean.to_utc_timestamp(F.col("written"))
    return _written_times(table(spark, sf, "events")).select(
        "event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("updated_at")
    )


@query("cast_date", """
SELECT event_id, CASE WHEN event_id % 5 < 4 THEN CAST(ts AS DATE) END AS written_day, CAST(ts AS DATE) AS day
FROM events""")
def _cast_date(spark: SparkSession, sf: str) -> DataFrame:
    return _written_times(table(spark, sf, "events")).select(
        "event_id",
        clean.to_day(F.col("written")).alias("written_day"),
        F.col("ts").cast("date").alias("day"),
    )


@query("normalize_columns", """
SELECT c_custkey AS cust_key, c_name AS full_name, c_nationkey AS nation_key, c_mktsegment AS "mkt-segment"
FROM customer""")
def _normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" Cust Key"),
        F.col("c_name").alias("Full/Name "),
        F.col("c_nationkey").alias("NATION_KEY"),
        F.col("c_mktsegment").alias("Mkt-Segment"),
    )
    return raw.toDF(*clean.normalize_names(raw.columns))


@query("lineage_source", """
SELECT o_orderkey, 'bronze.orders_' || lower(o_orderstatus) AS _source_table FROM orders""")
def _lineage_source(spark: SparkSession, sf: str) -> DataFrame:
    relation = F.concat(F.lit('"warehouse"."bronze"."orders_'), F.lower("o_orderstatus"), F.lit('"'))
    return table(spark, sf, "orders").select("o_orderkey", clean.lineage_name(relation).alias("_source_table"))


@query("union_schema_drift", """
SELECT o_orderkey AS order_key,
  CASE o_orderstatus WHEN 'O' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS DOUBLE) ELSE o_totalprice END AS total,
  CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS priority,
  CASE o_orderstatus WHEN 'O' THEN CAST(o_custkey AS VARCHAR) WHEN 'P' THEN 'C' || o_custkey END AS customer,
  CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE) WHEN 'P' THEN CAST(o_orderdate AS DATE) END AS day,
  'orders_' || lower(o_orderstatus) AS _source
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""")
def _union_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    part = lambda status: orders.filter(F.col("o_orderstatus") == status)
    day = F.col("o_orderdate").cast("date")
    return union_drifting(
        {
            "orders_f": part("F").select(
                F.col("o_orderkey").alias("Order Key"), F.col("o_totalprice").alias("Total"),
                F.col("o_orderpriority").alias("Priority"), day.alias("Day"),
            ),
            "orders_o": part("O").select(
                F.col("o_custkey").alias("Customer"), F.floor("o_totalprice").alias("TOTAL"),
                F.col("o_orderkey").alias("Order/Key"),
            ),
            "orders_p": part("P").select(
                day.alias("day"), F.concat(F.lit("C"), F.col("o_custkey")).alias("customer"),
                F.col("o_totalprice").alias("total"), F.col("o_orderkey").alias("order_key"),
            ),
        }
    )


BRANCH_COLUMNS = [
    "data_source", "country_region", "province_state", "admin2", "report_date", "fips_code", "iso3_code", "uid",
    "confirmed_cases", "people_tested", "testing_rate_per_100k", "mortality_rate_pct",
]


@query("union_branches", on_reports(f"SELECT {', '.join(BRANCH_COLUMNS)} FROM reports"))
def _union_branches(spark: SparkSession, sf: str) -> DataFrame:
    return fact_plan.combine_feeds(*trade.cleaned_reports(spark, sf)).select(*BRANCH_COLUMNS)


@query("silver_clean", f"""WITH {CELLS}
SELECT CAST(n_nationkey AS BIGINT) AS fips_code,
  CASE WHEN lines % 3 <> 0 THEN n_name END AS province_state,
  CASE WHEN lines % 4 <> 0 THEN r_name ELSE 'US' END AS country_region,
  84000000 + CAST(n_nationkey AS BIGINT) AS uid,
  CASE WHEN n_nationkey % 2 = 0 THEN 'N' || n_nationkey END AS iso3_code,
  CASE WHEN n_nationkey <> 0 THEN CAST(n_nationkey AS DOUBLE) END AS latitude,
  CAST(NULL AS DOUBLE) AS longitude,
  CASE WHEN lines % 5 <> 0 THEN COALESCE(all_units, 0) ELSE 0 END AS confirmed_cases,
  COALESCE(r_units, 0) AS total_deaths, COALESCE(a_units, 0) AS total_recovered,
  -COALESCE(n_units, 0) AS active_cases,
  CAST(0 AS BIGINT) AS total_test_results, lines AS people_tested, a_lines AS people_hospitalized,
  CASE WHEN a_lines > 0 THEN {rounded("CAST(discount AS DOUBLE) / lines")} END AS incident_rate_per_100k,
  CASE WHEN 3 * r_units <= 100 THEN CAST(3 * r_units AS DOUBLE) END AS case_fatality_ratio_pct,
  CAST(tax AS DOUBLE) AS testing_rate_per_100k,
  CAST(NULL AS DOUBLE) AS hospitalization_rate_pct,
  CAST(100 AS DOUBLE) AS mortality_rate_pct,
  CASE WHEN lines % 2 = 0 THEN CAST(day AS TIMESTAMP) END AS last_updated_at,
  day AS snapshot_date, 'bronze.us_' || strftime(day, '%m_%d_%Y') AS _source_table
FROM cells""")
def _silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Nation-days written as the text cells of a raw report, some spoilt, then cleaned."""
    lines, key, day = F.col("lines"), F.col("n_nationkey"), F.col("day")
    text = lambda c: c.cast("string")
    raw = trade.built_nation_days(spark, sf).select(
        F.concat(text(key), F.lit(".0")).alias("fips"),
        F.when(lines % 3 != 0, F.concat(F.lit(" "), F.col("n_name"))).otherwise(F.lit("  ")).alias("province_state"),
        F.when(lines % 4 != 0, F.col("r_name")).otherwise(F.lit("")).alias("country_region"),
        text(key + 84_000_000).alias("uid"),
        F.when(key % 2 == 0, F.concat(F.lit("N"), text(key))).otherwise(F.lit("NA")).alias("iso3"),
        text(key).alias("lat"),
        F.lit("0.0").alias("long_"),
        F.when(lines % 5 != 0, text(F.col("all_units"))).otherwise(F.lit("")).alias("confirmed"),
        text(F.col("r_units").cast("double")).alias("deaths"),
        text(F.col("a_units")).alias("recovered"),
        text(-F.col("n_units")).alias("active"),
        F.lit("nan").alias("total_test_results"),
        text(lines).alias("people_tested"),
        text(F.col("a_lines")).alias("people_hospitalized"),
        F.when(F.col("a_lines") > 0, text(m.round_half_up(F.col("discount").cast("double") / lines, 2)))
        .otherwise(F.lit("-1")).alias("incident_rate"),
        text(3 * F.col("r_units")).alias("case_fatality_ratio"),
        text(F.col("tax")).alias("testing_rate"),
        F.lit("100.1").alias("hospitalization_rate"),
        F.lit("100").alias("mortality_rate"),
        F.when(lines % 2 == 0, F.date_format(day, "M/d/yyyy H:mm")).otherwise(F.lit("soon")).alias("last_update"),
        text(day).alias("date"),
        F.concat(F.lit('"warehouse"."bronze"."us_'), F.date_format(day, "MM_dd_yyyy"), F.lit('"')).alias("_source"),
    )
    return silver.silver_us(raw).drop("_staged_at")


@query("silver_clean_global", f"""WITH {CELLS}
SELECT CAST(n_nationkey AS BIGINT) AS fips_code,
  CASE WHEN lines % 2 = 0 THEN r_name END AS admin2, n_name AS province_state,
  CASE WHEN lines % 4 <> 0 THEN r_name ELSE 'Unknown' END AS country_region,
  n_name || ', ' || r_name AS location_key,
  CASE WHEN n_nationkey <> 0 THEN CAST(n_nationkey AS DOUBLE) END AS latitude,
  CASE WHEN n_nationkey <> 0 THEN -n_nationkey / 2e0 END AS longitude,
  COALESCE(all_units, 0) AS confirmed_cases, COALESCE(r_units, 0) AS total_deaths,
  CAST(0 AS BIGINT) AS total_recovered, COALESCE(n_units, 0) AS active_cases,
  CASE WHEN lines % 3 <> 0 THEN CAST(lines AS DOUBLE) END AS incident_rate_per_100k,
  CASE WHEN all_units <= 100 THEN CAST(all_units AS DOUBLE) END AS case_fatality_ratio_pct,
  CAST(day AS TIMESTAMP) + INTERVAL 17 HOUR AS last_updated_at,
  'bronze.global_' || strftime(day, '%m_%d_%Y') AS _source_table
FROM cells""")
def _silver_clean_global(spark: SparkSession, sf: str) -> DataFrame:
    """Nation-days as text cells of the global feed, some spoilt, then cleaned."""
    lines, key, day = F.col("lines"), F.col("n_nationkey"), F.col("day")
    text = lambda c: c.cast("string")
    raw = trade.built_nation_days(spark, sf).select(
        text(key).alias("fips"),
        F.when(lines % 2 == 0, F.col("r_name")).otherwise(F.lit(" ")).alias("admin2"),
        F.concat(F.col("n_name"), F.lit("  ")).alias("province_state"),
        F.when(lines % 4 != 0, F.col("r_name")).otherwise(F.lit("   ")).alias("country_region"),
        F.concat("n_name", F.lit(", "), "r_name").alias("combined_key"),
        text(key).alias("lat"),
        text(-key / 2).alias("long_"),
        text(F.col("all_units")).alias("confirmed"),
        F.concat(text(F.col("r_units")), F.lit(".0")).alias("deaths"),
        F.lit(None).cast("string").alias("recovered"),
        text(F.col("n_units")).alias("active"),
        F.when(lines % 3 != 0, text(lines)).otherwise(text(-lines)).alias("incident_rate"),
        text(F.col("all_units")).alias("case_fatality_ratio"),
        F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 17:00")).alias("last_update"),
        F.concat(F.lit('"warehouse"."bronze"."global_'), F.date_format(day, "MM_dd_yyyy"), F.lit('"')).alias("_source"),
    )
    return silver.silver_global(raw).drop("_staged_at")
