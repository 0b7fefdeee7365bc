"""Ranks, percentiles, shares and ladders over all customers, and correlation pairs of the order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import labels
from almanac.functions import metrics as m
from almanac.operators.context import with_group_totals
from almanac.operators.correlate import Pair, pair_statistics
from almanac.operators.latest import latest_per_key
from almanac.operators.ranking import Percentile, Rank, top_rows, with_ranks, with_share
from almanac.plans import agg, mart, trade
from almanac.plans.trade import table
from almanac.queries.models import COUNTRIES, DAYS, PAIR_STATISTICS, STATES
from almanac.queries import expected
from almanac.queries.registry import ladder, on_fact, query, rounded

# A customer without orders has no total, which ranks first.
SPENDERS = """
WITH spenders AS (
  SELECT c_custkey, c_nationkey, CAST(SUM(CAST(floor(o_totalprice * 100 + 0.5e0) AS BIGINT)) AS DOUBLE) / 100 AS spent,
    COUNT(o_orderkey) AS n
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL
)"""


def _spenders(spark: SparkSession, sf: str) -> DataFrame:
    """Totals per customer as a written table that the queries below share."""
    return trade.build_once("spenders", spark, sf, _spent)


def _spent(spark: SparkSession, sf: str) -> DataFrame:
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        (F.sum(trade.hundredths("o_totalprice")).cast("double") / 100).alias("spent"),
        F.count("*").alias("n"),
    )
    joined = table(spark, sf, "customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "c_nationkey", "spent", F.coalesce("n", F.lit(0)).alias("n"))


@query("rank_global", f"""{SPENDERS}
SELECT c_custkey, spent, ROW_NUMBER() OVER (ORDER BY spent DESC NULLS FIRST, c_custkey) AS rank_by_spent,
  ROW_NUMBER() OVER (ORDER BY n DESC NULLS FIRST, c_custkey) AS rank_by_orders FROM spenders""")
def _rank_global(spark: SparkSession, sf: str) -> DataFrame:
    ranks = [Rank("rank_by_spent", "spent"), Rank("rank_by_orders", "n")]
    return with_ranks(_spenders(spark, sf), "c_custkey", ranks).select(
        "c_custkey", "spent", "rank_by_spent", "rank_by_orders"
    )


@query("percentile_rank", f"""{SPENDERS}
SELECT c_custkey, {rounded("PERCENT_RANK() OVER (ORDER BY spent NULLS LAST)", 4)} AS spent_percentile,
  {rounded("PERCENT_RANK() OVER (ORDER BY n)", 4)} AS orders_percentile FROM spenders""")
def _percentile_rank(spark: SparkSession, sf: str) -> DataFrame:
    shares = [Percentile("spent_percentile", "spent"), Percentile("orders_percentile", "n")]
    return with_ranks(_spenders(spark, sf), "c_custkey", [], shares).select(
        "c_custkey", "spent_percentile", "orders_percentile"
    )


@query("rank_ladder", f"""{SPENDERS}
SELECT c_custkey, {ladder("r", expected.STATE_IMPACT)} AS impact, {ladder("r", expected.GLOBAL_TIER)} AS tier,
  {ladder("r", expected.TOP_TIER)} AS top_tier
FROM (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY spent DESC NULLS FIRST, c_custkey) AS r FROM spenders)""")
def _rank_ladder(spark: SparkSession, sf: str) -> DataFrame:
    ranked = with_ranks(_spenders(spark, sf), "c_custkey", [Rank("r", "spent")])
    r = F.col("r")
    return ranked.select(
        "c_custkey", labels.STATE_IMPACT(r).alias("impact"), labels.GLOBAL_TIER(r).alias("tier"),
        labels.TOP_TIER(r).alias("top_tier"),
    )


@query("share_of_total", f"""{SPENDERS}
SELECT c_custkey, {rounded("1e2 * spent / (SELECT SUM(spent) FROM spenders)")} AS pct_of_spent FROM spenders""")
def _share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    return with_share(_spenders(spark, sf), "spent", "pct_of_spent").select("c_custkey", "pct_of_spent")


@query("top_n_ranked", f"""{SPENDERS}
SELECT * EXCLUDE (c_nationkey, n) FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY n DESC NULLS FIRST, c_custkey) AS rank_by_orders,
    {rounded("1e2 * n / (SUM(n) OVER ())", 2)} AS pct_of_orders FROM spenders)
WHERE rank_by_orders <= 5""")
def _top_n_ranked(spark: SparkSession, sf: str) -> DataFrame:
    customers = _spenders(spark, sf)
    best = top_rows(customers, "n", "c_custkey", 5, "rank_by_orders")
    return with_share(best, "n", "pct_of_orders", customers).drop("c_nationkey", "n")


MEAN_DISCOUNT = "CAST(SUM(CAST(floor(l_discount * 100 + 0.5e0) AS BIGINT)) AS DOUBLE) / COUNT(l_discount)"


@query("rate_ladder", f"""
SELECT l_orderkey, {ladder(MEAN_DISCOUNT, expected.FATALITY_CLASS)} AS discount_class
FROM lineitem GROUP BY l_orderkey""")
def _rate_ladder(spark: SparkSession, sf: str) -> DataFrame:
    mean = F.try_divide(F.sum(trade.hundredths("l_discount")).cast("double"), F.count("l_discount"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        labels.FATALITY_CLASS(mean).alias("discount_class")
    )


@query("trend_strength", on_fact(f"""
SELECT country_region, province_state, report_date,
  {ladder("abs(pct_change_cases)", expected.TREND_STRENGTH)} AS trend_strength FROM fact"""))
def _trend_strength(spark: SparkSession, sf: str) -> DataFrame:
    return trade.built_fact(spark, sf).select(
        "country_region", "province_state", "report_date",
        labels.TREND_STRENGTH(F.abs("pct_change_cases")).alias("trend_strength"),
    )


@query("trend_label_total", on_fact("""
SELECT snapshot_date, CASE WHEN coalesce(total_active_cases - LAG(total_active_cases) OVER w, 0) > 0 THEN 'Rising'
  WHEN coalesce(total_active_cases - LAG(total_active_cases) OVER w, 0) < 0 THEN 'Falling' ELSE 'Stable' END AS trend
FROM days WINDOW w AS (ORDER BY snapshot_date)""", DAYS))
def _trend_label_total(spark: SparkSession, sf: str) -> DataFrame:
    active = F.col("total_active_cases")
    days = agg.day_totals(trade.built_fact(spark, sf))
    before = F.lag(active).over(agg.whole_series("snapshot_date"))
    return days.select("snapshot_date", labels.total_trend(active, before).alias("trend"))


# Columns of one order line that are correlated; the last pair has a constant column.
LINE_PAIRS = [
    Pair("Quantity vs Price", "l_quantity", "l_extendedprice", ("l_extendedprice",)),
    Pair("Discount vs Tax", "l_discount", "l_tax", ("l_discount", "l_tax")),
    Pair("Line vs Taxed Quantity", "l_linenumber", "taxed", ("taxed",)),
    Pair("Quantity vs One", "l_quantity", "one", ("one",)),
]
LINES = "(SELECT *, CASE WHEN l_tax > 0 THEN l_quantity END AS taxed, 1 AS one FROM lineitem WHERE l_quantity > 0)"


def _line_pair_sql(pair: Pair) -> str:
    x, y = pair.first, pair.second
    return f"""SELECT '{pair.name}' AS metric_pair,
  {rounded(f"CASE WHEN NOT isnan(corr({x}, {y})) THEN corr({x}, {y}) END", 4)} AS correlation_coefficient,
  COUNT(*) AS sample_size, {rounded(f"AVG({x})")} AS metric_1_avg, {rounded(f"AVG({y})")} AS metric_2_avg,
  {rounded(f"stddev_samp({x})")} AS metric_1_stddev, {rounded(f"stddev_samp({y})")} AS metric_2_stddev
  FROM lines WHERE {' AND '.join(f'{c} IS NOT NULL' for c in pair.needs)}"""


@query("corr_pairs", f"WITH lines AS {LINES}\n" + "\nUNION ALL\n".join(_line_pair_sql(p) for p in LINE_PAIRS))
def _corr_pairs(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 0).withColumns(
        {"taxed": F.when(F.col("l_tax") > 0, F.col("l_quantity")), "one": F.lit(1)}
    )
    return pair_statistics(lines, LINE_PAIRS).select(*mart.rounded_statistics())


@query("corr_labels", on_fact(f"""
SELECT metric_pair, {ladder("abs(r)", expected.CORRELATION_STRENGTH)} AS correlation_strength,
  CASE WHEN r > 0 THEN 'Positive' WHEN r < 0 THEN 'Negative' ELSE 'None' END AS correlation_direction,
  {ladder("sample_size", expected.CONFIDENCE)} AS statistical_confidence,
  CASE WHEN metric_pair = 'Daily New Cases vs Test Positivity Rate' THEN FALSE ELSE TRUE END AS has_explanation
FROM pairs""", PAIR_STATISTICS))
def _corr_labels(spark: SparkSession, sf: str) -> DataFrame:
    statistics = mart.us_pair_statistics(trade.built_fact(spark, sf))
    explained = labels.explanation(F.col("metric_pair"), labels.REPORT_EXPLANATIONS)
    return statistics.select(
        "metric_pair",
        *mart.described(F.col("correlation_coefficient"), F.col("sample_size"), labels.CONFIDENCE),
        (explained != labels.NO_EXPLANATION).alias("has_explanation"),
    )


@query("rank_in_ranges", f"""
WITH units AS (SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS units FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, units, ROW_NUMBER() OVER (ORDER BY units DESC NULLS FIRST, l_orderkey) AS by_units,
  {rounded("PERCENT_RANK() OVER (ORDER BY units NULLS LAST)", 4)} AS share FROM units""")
def _rank_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """All orders ranked by range partitions, the way that large group counts take."""
    quantity = F.sum(F.col("l_quantity")).cast("bigint").alias("units")
    units = trade.build_once("units", spark, sf, lambda spark, sf: table(spark, sf, "lineitem").groupBy("l_orderkey").agg(quantity))
    return with_ranks(units, "l_orderkey", [Rank("by_units", "units")], [Percentile("share", "units")], max(1, units.count() // 8))


@query("weekly_context", """
SELECT event_id, COUNT(*) OVER week AS weekly_events, MAX(value) OVER week AS weekly_peak,
  CAST(ROUND(CAST(AVG(value) OVER week AS DECIMAL(38,10)), 2) AS DOUBLE) AS weekly_avg
FROM events WINDOW week AS (PARTITION BY event_type, year(ts), weekofyear(ts))""")
def _weekly_context(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.year("ts").alias("year"), F.weekofyear("ts").alias("week")
    )
    return with_group_totals(
        events,
        ["event_type", "year", "week"],
        {
            "weekly_events": F.count("*"),
            "weekly_peak": F.max("value"),
            "weekly_avg": m.round_half_up(F.avg("value"), 2),
        },
    ).select("event_id", "weekly_events", "weekly_peak", "weekly_avg")


@query("daily_totals", on_fact("""
SELECT * FROM days""", DAYS))
def _daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    return agg.day_totals(trade.built_fact(spark, sf)).withColumnsRenamed(
        {"total_confirmed_cases": "cases", "total_deaths": "deaths"}
    )


@query("daily_series", f"""
WITH days AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1)
SELECT day, n, COALESCE(n - LAG(n) OVER (ORDER BY day), 0) AS new_events,
  {rounded("AVG(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")} AS events_7day FROM days""")
def _daily_series(spark: SparkSession, sf: str) -> DataFrame:
    series = agg.whole_series("day")
    days = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return days.select(
        "day", "n",
        m.delta(F.col("n"), F.lag("n").over(series)).alias("new_events"),
        m.round_half_up(F.avg("n").over(series.rowsBetween(-6, 0)), 2).alias("events_7day"),
    )


@query("state_peaks", on_fact("""
SELECT province_state, days_reporting, latest_report_date, cases, deaths, total_people_tested FROM states""", STATES))
def _state_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return agg.state_totals(trade.built_fact(spark, sf)).select(
        "province_state", "days_reporting", "latest_report_date",
        F.col("total_confirmed_cases").alias("cases"), F.col("total_deaths").alias("deaths"), "total_people_tested",
    )


@query("country_totals", on_fact(f"""
SELECT country_region, data_points, provinces_reporting, unique_locations, cases, recovered,
  {rounded("r1")} AS avg_incident_rate FROM countries""", COUNTRIES))
def _country_totals(spark: SparkSession, sf: str) -> DataFrame:
    return agg.country_totals(trade.built_fact(spark, sf)).select(
        "country_region", "data_points", "provinces_reporting", "unique_locations",
        F.col("total_confirmed_cases").alias("cases"), F.col("total_recovered").alias("recovered"),
        m.round_half_up(F.col("avg_incident_rate_per_100k"), 2).alias("avg_incident_rate"),
    )


@query("max_label", on_fact("""
SELECT country_region, MAX(severity_category) AS severity, MAX(case_trend) AS trend FROM fact GROUP BY ALL"""))
def _max_label(spark: SparkSession, sf: str) -> DataFrame:
    return trade.built_fact(spark, sf).groupBy("country_region").agg(
        F.max("severity_category").alias("severity"), F.max("case_trend").alias("trend")
    )


@query("latest_snapshot_join", """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
JOIN (SELECT o_custkey, MAX(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey) newest
  USING (o_custkey, o_orderdate)""")
def _latest_snapshot_join(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(table(spark, sf, "orders"), "o_custkey", "o_orderdate").select(
        "o_custkey", "o_orderkey", "o_orderdate"
    )
