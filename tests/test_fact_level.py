"""Summaries, marts and reports over hand-made fact rows."""

import datetime as dt
import shutil

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from almanac.functions import labels
from almanac.plans import adhoc, agg, mart, report, trade
from almanac.plans.fact import FACT_COLUMNS

DAY = dt.date(2021, 3, 1)
TYPES = {
    "report_date": "date", "report_year": "bigint", "week_of_year": "bigint", "report_month": "bigint",
    "last_updated_at": "timestamp", "_staged_at": "timestamp", "_fact_created_at": "timestamp",
    "has_new_cases": "boolean", "has_new_deaths": "boolean", "latitude": "double", "longitude": "double",
}


def column_type(name):
    if name in TYPES:
        return TYPES[name]
    if name.endswith(("_avg", "_pct", "_per_100k")) or name.startswith("pct_"):
        return "double"
    counts = ("confirmed_cases", "total_deaths", "total_recovered", "active_cases", "total_test_results",
              "people_tested", "people_hospitalized", "daily_new_cases", "daily_new_deaths", "daily_new_tests",
              "fips_code", "uid", "report_day")
    return "bigint" if name in counts else "string"


def facts(spark, *rows):
    """Fact rows from the given values; everything else is absent."""
    default = {"data_source": "US", "country_region": "US", "report_date": DAY, "total_deaths": 0, "total_recovered": 0}
    filled = [{**default, **r} for r in rows]
    schema = ", ".join(f"{c} {column_type(c)}" for c in FACT_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in FACT_COLUMNS) for r in filled], schema)


def test_state_rank_edges_and_ties(spark):
    rows = [{"province_state": f"S{i:02d}", "confirmed_cases": 1000 - i} for i in range(1, 34)]
    rows.append({"province_state": "A first of equals", "confirmed_cases": 1000 - 5})
    got = {r.province_state: r for r in agg.state_summary(facts(spark, *rows)).collect()}
    assert got["A first of equals"].national_rank_cases == 5 and got["S05"].national_rank_cases == 6
    by_rank = {r.national_rank_cases: r.impact_category for r in got.values()}
    assert [by_rank[i] for i in (1, 5, 6, 10, 11, 20, 21, 30, 31, 34)] == [
        "Top 5 - Critical", "Top 5 - Critical", "Top 10 - Severe", "Top 10 - Severe", "Top 20 - High",
        "Top 20 - High", "Moderate", "Moderate", "Lower Impact", "Lower Impact",
    ]
    assert got["A first of equals"].cases_percentile == got["S05"].cases_percentile == round(28 / 33, 4)
    assert got["S33"].cases_percentile == 0.0 and got["S01"].cases_percentile == 1.0


def test_a_single_state(spark):
    rows = facts(spark, {"province_state": "S", "confirmed_cases": 0}, {"province_state": None, "confirmed_cases": 9},
                 {"data_source": "Global", "province_state": "G", "confirmed_cases": 9})
    (only,) = agg.state_summary(rows).collect()
    assert (only.province_state, only.cases_percentile, only.overall_case_fatality_ratio_pct) == ("S", 0.0, None)


def test_country_tiers_shares_and_classes(spark):
    rows = [
        {"data_source": "Global", "country_region": f"C{i:02d}", "confirmed_cases": 100, "case_fatality_ratio_pct": i / 10}
        for i in range(52)
    ] + [{"data_source": "Global", "country_region": "Unknown", "confirmed_cases": 10**6}]
    got = {r.country_region: r for r in agg.country_summary(facts(spark, *rows)).collect()}
    assert len(got) == 52 and got["C00"].pct_of_global_cases == 1.92
    tiers = [got[f"C{i:02d}"].global_impact_tier for i in (0, 9, 10, 24, 25, 49, 50)]
    assert tiers == ["Top 10 Globally"] * 2 + ["Top 25 Globally"] * 2 + ["Top 50 Globally"] * 2 + ["Other"]
    classes = [got[f"C{i:02d}"].severity_classification for i in (9, 10, 20, 30, 50)]
    assert classes == ["Very Low Severity", "Low Severity", "Moderate Severity", "High Severity", "Very High Severity"]


def test_country_totals_add_running_counts_over_dates(spark):
    rows = facts(
        spark,
        {"confirmed_cases": 10, "province_state": "a", "location_name": "a, US", "incident_rate_per_100k": 1.0},
        {"confirmed_cases": 30, "province_state": "a", "location_name": "a, US", "report_date": DAY + dt.timedelta(1)},
        {"confirmed_cases": 5, "location_name": "US", "incident_rate_per_100k": 4.0},
    )
    (got,) = agg.country_totals(rows).collect()
    assert (got.total_confirmed_cases, got.data_points, got.provinces_reporting, got.unique_locations) == (45, 3, 1, 2)
    assert got.avg_incident_rate_per_100k == 2.5 and got.avg_case_fatality_ratio_pct is None
    assert got.max_single_location_cases == 30


def test_largest_label_is_the_largest_text(spark):
    rows = facts(
        spark,
        {"confirmed_cases": 2 * 10**6, "severity_category": "Critical", "case_trend": "Decreasing", "province_state": "a"},
        {"confirmed_cases": 1, "severity_category": "Very Low", "case_trend": "Unknown", "province_state": "b"},
    )
    assert mart.top_countries(rows).collect()[0].peak_severity_category == "Very Low"
    same_state = rows.withColumn("province_state", F.lit("a"))
    assert report.trends_over_time(same_state).collect()[0].trend_direction == "Unknown"


def test_top_countries_use_the_latest_date_of_each(spark):
    old = DAY - dt.timedelta(days=9)
    rows = facts(
        spark,
        {"country_region": "A", "confirmed_cases": 999, "report_date": old},
        {"country_region": "A", "confirmed_cases": 60},
        {"country_region": "A", "confirmed_cases": 10},
        {"country_region": "B", "confirmed_cases": 30, "report_date": old},
        {"country_region": "Unknown", "confirmed_cases": 100},
        {"country_region": "C", "confirmed_cases": 50, "report_date": None},
    )
    got = mart.top_countries(rows).orderBy("rank_by_cases").collect()
    assert [(r.country_region, r.total_confirmed_cases, r.pct_of_global_cases) for r in got] == [
        ("Unknown", 100, 50.0), ("A", 70, 35.0), ("B", 30, 15.0),
    ]
    got = report.top_countries_by_cases(rows).orderBy("rank_by_cases").collect()
    assert [(r.country_region, r.pct_of_global_cases, r.severity_tier) for r in got] == [
        ("A", 70.0, "Highest"), ("B", 30.0, "Very High"),
    ]


def test_daily_summary(spark):
    rows = facts(
        spark,
        *[
            {"report_date": DAY + dt.timedelta(days=i), "province_state": s, "confirmed_cases": n, "total_deaths": 1}
            for i, n in [(0, 10), (1, 10), (4, 5), (5, 20)]
            for s in ("a", "b")
        ],
    )
    got = agg.daily_summary(rows).orderBy("snapshot_date").collect()
    assert [(r.new_cases_today, r.case_trend, r.cases_7day_rolling_avg) for r in got] == [
        (0, "Stable", 20.0), (0, "Stable", 20.0), (-10, "Falling", 16.67), (30, "Rising", 22.5),
    ]
    assert got[0].total_people_tested is None and got[0].test_positivity_rate_pct is None
    assert [r.snapshot_date for r in adhoc.last_days(agg.daily_summary(rows), 2).collect()] == [
        DAY + dt.timedelta(days=5), DAY + dt.timedelta(days=4),
    ]


def test_correlation_of_a_single_row(spark):
    rows = facts(
        spark,
        {"confirmed_cases": 5, "total_deaths": 1, "testing_rate_per_100k": 2.0},
        {"confirmed_cases": 0, "total_deaths": 9},
        {"confirmed_cases": 7, "total_deaths": 9, "report_date": None},
    )
    got = {r.metric_pair: r for r in mart.correlation_metrics(rows).collect()}
    one = got[labels.CASES_DEATHS]
    assert (one.sample_size, one.correlation_coefficient, one.metric_1_stddev, one.r_squared) == (1, None, None, None)
    assert (one.correlation_strength, one.correlation_direction, one.statistical_confidence) == (
        "Very Weak or None", "None", "Low confidence",
    )
    assert got[labels.TESTING_INCIDENT].sample_size == 0 and len(got) == 5
    texts = {r.metric_pair: r.interpretation for r in report.correlation_analysis(rows).collect()}
    assert texts[labels.NEW_CASES_POSITIVITY] == labels.NO_EXPLANATION


def test_trend_groups_with_an_absent_week(spark):
    rows = facts(
        spark,
        {"province_state": "a", "report_date": None, "daily_new_cases": 4},
        {"province_state": "a", "report_date": None, "daily_new_cases": 6, "pct_change_cases": -12.0},
        {"province_state": "a", "report_year": 2021, "week_of_year": 9, "daily_new_cases": 1},
    )
    got = sorted((r.daily_new_cases, r.weekly_total_new_cases, r.trend_strength) for r in mart.trends(rows).collect())
    assert got == [(1, 1, "Minimal"), (4, 10, "Minimal"), (6, 10, "Moderate")]


def test_written_tables_follow_their_inputs(spark, tmp_path):
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    first = trade.built_fact(spark, str(tmp_path))
    rows = first.count()
    assert trade.built_fact(spark, str(tmp_path)) is first
    half = pq.read_table(tmp_path / "orders.parquet").slice(0, 700)
    pq.write_table(half, tmp_path / "orders.parquet")
    assert 0 < trade.built_fact(spark, str(tmp_path)).count() < rows
