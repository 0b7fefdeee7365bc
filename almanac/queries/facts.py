"""Operators of the fact, one by one, and the whole fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import labels
from almanac.functions import metrics as m
from almanac.operators.series import SeriesMetrics, with_series
from almanac.plans import fact as fact_plan
from almanac.plans import trade
from almanac.plans.trade import table
from almanac.queries.registry import on_fact, pct, query, rounded

# Build times differ from run to run.
STABLE_COLUMNS = [c for c in fact_plan.FACT_COLUMNS if c not in ("_staged_at", "_fact_created_at")]
PLACE = ["country_region", "province_state", "report_date"]


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return with_series(trade.built_reports(spark, sf), fact_plan.LOCATION, fact_plan.SERIES_ORDER, fact_plan.SERIES, one_row_per_day=True)


@query("fact_daily", on_fact(f"SELECT {', '.join(STABLE_COLUMNS)} FROM fact"))
def _fact_daily(spark: SparkSession, sf: str) -> DataFrame:
    return trade.fact(spark, sf).select(*STABLE_COLUMNS)


@query("lag_by_location", on_fact(f"""
SELECT {', '.join(PLACE)}, confirmed_cases, prev_cases, prev_deaths, prev_tested FROM compared"""))
def _lag_by_location(spark: SparkSession, sf: str) -> DataFrame:
    return _series(spark, sf).select(
        *PLACE, "confirmed_cases",
        F.col("_prev_cases").alias("prev_cases"),
        F.col("_prev_deaths").alias("prev_deaths"),
        F.col("_prev_tested").alias("prev_tested"),
    )


@query("rolling_7row", on_fact(f"""
SELECT {', '.join(PLACE)}, {rounded("mean_cases")} AS cases_7row, {rounded("mean_deaths")} AS deaths_7row
FROM compared"""))
def _rolling_7row(spark: SparkSession, sf: str) -> DataFrame:
    return _series(spark, sf).select(
        *PLACE,
        m.round_half_up(F.col("_mean_cases"), 2).alias("cases_7row"),
        m.round_half_up(F.col("_mean_deaths"), 2).alias("deaths_7row"),
    )


@query("daily_delta", on_fact(f"""
SELECT {', '.join(PLACE)}, COALESCE(active_cases - prev_deaths, 0) AS mixed,
  COALESCE(confirmed_cases - prev_cases, 0) AS new_cases, COALESCE(people_tested - prev_tested, 0) AS new_tests
FROM compared"""))
def _daily_delta(spark: SparkSession, sf: str) -> DataFrame:
    return _series(spark, sf).select(
        *PLACE,
        m.delta(F.col("active_cases"), F.col("_prev_deaths")).alias("mixed"),  # falls below zero as well
        m.delta(F.col("confirmed_cases"), F.col("_prev_cases")).alias("new_cases"),
        m.delta(F.col("people_tested"), F.col("_prev_tested")).alias("new_tests"),
    )


@query("pct_change", on_fact(f"""
SELECT {', '.join(PLACE)}, {pct("confirmed_cases - prev_cases", "prev_cases")} AS cases_change,
  {pct("active_cases - prev_deaths", "prev_deaths")} AS mixed_change
FROM compared"""))
def _pct_change(spark: SparkSession, sf: str) -> DataFrame:
    return _series(spark, sf).select(
        *PLACE,
        m.pct_change(F.col("confirmed_cases"), F.col("_prev_cases")).alias("cases_change"),
        m.pct_change(F.col("active_cases"), F.col("_prev_deaths")).alias("mixed_change"),
    )


@query("has_new_flag", on_fact(f"""
SELECT {', '.join(PLACE)}, has_new_cases, has_new_deaths FROM fact"""))
def _has_new_flag(spark: SparkSession, sf: str) -> DataFrame:
    return trade.fact(spark, sf).select(*PLACE, "has_new_cases", "has_new_deaths")


@query("trend_label", on_fact(f"""
SELECT {', '.join(PLACE)}, CASE WHEN active_cases > prev_deaths THEN 'Increasing'
  WHEN active_cases < prev_deaths THEN 'Decreasing' WHEN active_cases = prev_deaths THEN 'Stable'
  ELSE 'Unknown' END AS trend FROM compared"""))
def _trend_label(spark: SparkSession, sf: str) -> DataFrame:
    return _series(spark, sf).select(
        *PLACE, labels.case_trend(F.col("active_cases"), F.col("_prev_deaths")).alias("trend")
    )


@query("severity_ladder", """
SELECT o_orderkey, CASE WHEN 3 * o_totalprice >= 1e6 THEN 'Critical' WHEN 3 * o_totalprice >= 5e5 THEN 'Very High'
  WHEN 3 * o_totalprice >= 1e5 THEN 'High' WHEN 3 * o_totalprice >= 1e4 THEN 'Moderate'
  WHEN 3 * o_totalprice >= 1e3 THEN 'Low' ELSE 'Very Low' END AS severity FROM orders""")
def _severity_ladder(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", labels.SEVERITY(3 * F.col("o_totalprice")).alias("severity")
    )


@query("surrogate_key", """
SELECT o_orderkey, md5(list_aggregate(list_transform([o_orderstatus, o_orderpriority,
  CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END, '', CAST(CAST(o_orderdate AS DATE) AS VARCHAR)],
  lambda p: COALESCE(p, '_dbt_utils_surrogate_key_null_')), 'string_agg', '-')) AS order_hash
FROM orders""")
def _surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        m.surrogate_key(
            F.col("o_orderstatus"), F.col("o_orderpriority"),
            F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")),
            F.lit(""), F.col("o_orderdate").cast("date"),
        ).alias("order_hash"),
    )


@query("location_name", """
SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 4 <> 0 THEN c_name END || ', ' || n_name, n_name) AS location_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _location_name(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    named = F.when(F.col("c_custkey") % 4 != 0, F.col("c_name"))
    return customers.select("c_custkey", m.location_name(named, F.col("n_name")).alias("location_name"))


@query("date_parts", """
SELECT o_orderkey, year(o_orderdate) AS report_year, month(o_orderdate) AS report_month,
  day(o_orderdate) AS report_day, rpad(dayname(o_orderdate), 9, ' ') AS day_of_week,
  weekofyear(o_orderdate) AS week_of_year FROM orders""")
def _date_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = m.date_parts(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(name) for name, c in parts.items()])


@query("safe_pct", f"""
SELECT event_id, {pct("value", "(event_id % 9 - 4)")} AS share FROM events""")
def _safe_pct(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.col("event_id") % 9 - 4  # below zero, zero and above
    return table(spark, sf, "events").select("event_id", m.safe_pct(F.col("value"), whole).alias("share"))


@query("round_half_up", f"""
SELECT l_orderkey, l_linenumber, {rounded("l_extendedprice * l_discount")} AS places_2,
  {rounded("l_extendedprice * l_tax / 7", 4)} AS places_4 FROM lineitem""")
def _round_half_up(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        m.round_half_up(price * F.col("l_discount"), 2).alias("places_2"),
        m.round_half_up(price * F.col("l_tax") / 7, 4).alias("places_4"),
    )


_ORDER_SERIES = SeriesMetrics(previous={"prev_price": "o_totalprice"}, trailing_mean={"mean_customer": "o_custkey"})


def _order_series_sql(location: str) -> str:
    return f"""
SELECT o_orderkey, {location}, LAG(o_totalprice) OVER w AS prev_price,
  {rounded("AVG(o_custkey) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 4)} AS mean_customer
FROM orders WINDOW w AS (PARTITION BY {location} ORDER BY o_orderdate NULLS LAST, o_orderkey)"""


def _order_series(spark: SparkSession, sf: str, location: str, **sizes: int) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", location, "o_orderdate", "o_totalprice", "o_custkey")
    rows = with_series(orders, [location], ["o_orderdate", "o_orderkey"], _ORDER_SERIES, **sizes)
    return rows.select("o_orderkey", location, "prev_price", m.round_half_up(F.col("mean_customer"), 4).alias("mean_customer"))


@query("lag_by_customer", _order_series_sql("o_custkey"))
def _lag_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """As many locations as customers, with several rows on a day: grows with the tables."""
    return _order_series(spark, sf, "o_custkey")


@query("lag_hot_location", _order_series_sql("o_orderstatus"))
def _lag_hot_location(spark: SparkSession, sf: str) -> DataFrame:
    """Three locations that hold all orders, cut into blocks as a location beyond the size of one task is."""
    return _order_series(spark, sf, "o_orderstatus", hot_rows=1, block_rows=max(1, table(spark, sf, "orders").count() // 12))


@query("build_stamps", on_fact("""
SELECT data_source, COUNT(*) AS n, COUNT(*) AS staged, COUNT(*) AS created, TRUE AS in_order FROM fact GROUP BY ALL"""))
def _build_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of the fact says when it was cleaned and when it was built, in this order."""
    return trade.built_fact(spark, sf).groupBy("data_source").agg(
        F.count("*").alias("n"), F.count("_staged_at").alias("staged"), F.count("_fact_created_at").alias("created"),
        F.bool_and(F.col("_staged_at") <= F.col("_fact_created_at")).alias("in_order"),
    )
