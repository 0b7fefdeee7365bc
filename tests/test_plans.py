"""Plans: what is scanned, what is shuffled, what runs in one task."""

import re

import pytest


from almanac.operators import quality
from almanac.plans import adhoc, agg, fact as fact_plan, mart, report, trade
from almanac.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, mode="formatted"):
    """The executed plan, after adaptive changes when the rows have been read."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def simple_plan(df):
    return plan_of(df, "simple")


@pytest.fixture(scope="module")
def fact(spark):
    return trade.built_fact(spark, SF_DIR)


def test_lines_are_combined_per_order_before_the_join(spark):
    plan = simple_plan(trade.nation_days(spark, SF_DIR))
    assert plan.count("lineitem.parquet") == 1
    assert "partial_sum(cast(l_quantity" in plan
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in scan and "l_shipdate" not in scan


def test_fact_shuffles_each_feed_once_by_location(spark):
    us, elsewhere = trade.cleaned_reports(spark, SF_DIR)
    # the cleaned tables as written tables, as a run over the layers has them
    from almanac.sources.stage import stage

    df = fact_plan.fact_daily(stage(us, "us"), stage(elsewhere, "elsewhere"), one_row_per_day=True)
    plan = simple_plan(df)
    assert plan.count("Exchange hashpartitioning(country_region") == plan.count("Exchange") == plan.count("Window [") == 2


def test_unused_series_columns_need_no_shuffle(spark):
    us, elsewhere = trade.cleaned_reports(spark, SF_DIR)
    rows = fact_plan.fact_daily(us, elsewhere, one_row_per_day=True).select("fact_key", "report_date")
    # only the running totals of the order book remain out, and those are not asked for
    assert "Window [" not in simple_plan(rows)


def test_source_filter_prunes_partitions_and_columns(fact):
    plan = simple_plan(report.trends_over_time(fact))
    assert re.search(r"PartitionFilters: \[isnotnull\(data_source#\d+\), \(data_source#\d+ = US\)\]", plan)
    assert "fact_key" not in plan and "latitude" not in plan


def test_feed_filter_reaches_the_scan(spark):
    us, _ = trade.cleaned_reports(spark, SF_DIR)
    assert "EqualTo(r_name,AMERICA)" in simple_plan(us)


def test_correlations_scan_the_fact_once(fact):
    plan = simple_plan(mart.correlation_metrics(fact))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_weekly_totals_do_not_shuffle_the_rows(fact):
    plan = simple_plan(mart.trends(fact))
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_latest_rows_are_filtered_where_they_are_read(fact):
    from almanac.operators.latest import latest_per_key

    plan = simple_plan(latest_per_key(fact, "country_region", "report_date"))
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_latest_rows_beyond_the_broadcast_threshold_are_shuffled(spark, fact):
    from almanac.operators.latest import latest_per_key

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = simple_plan(latest_per_key(fact, "country_region", "report_date"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_top_countries_number_only_the_kept_rows(fact):
    plan = simple_plan(mart.top_countries(fact))
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [row_number" in line)
    assert "TakeOrderedAndProject(limit=5" in lines[window + 1]


SERIES_BY_DATE = {"agg_daily_summary", "trend_label_total", "daily_series", "last_30_days"}
# ranked over a staged group table whose rows have been counted
COUNTED = {"agg_country_summary", "agg_state_summary", "rank_global", "rank_ladder", "percentile_rank"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows_are_gathered_in_one_task(spark, name):
    """SinglePartition only above an aggregate, a limit, a counted group table or a series of dates."""
    plan = simple_plan(QUERIES[name](spark, SF_DIR))
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line or name in SERIES_BY_DATE:
            continue
        below = lines[i + 1]
        counted = name in COUNTED and "checkpoints/almanac" in below
        assert "HashAggregate" in below or "Limit" in below or counted, f"{line}\n{below}"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_queries_read_whole_tables(spark):
    for name, build in QUERIES.items():
        assert not re.search(r"\bSample\b", simple_plan(build(spark, SF_DIR))), name


def test_no_local_checkpoint_and_no_python_udf():
    from pathlib import Path

    source = "\n".join(p.read_text() for p in (Path(__file__).parent.parent / "almanac").rglob("*.py"))
    for word in ("localCheckpoint", "crossJoin", "F.udf", "pandas_udf", ".toPandas(", ".cache(", ".persist("):
        assert word not in source, word


def test_state_ranks_are_checked_by_count(spark, fact):
    plain = agg.state_summary(fact).orderBy("province_state").collect()
    spread = agg.state_summary(fact, one_task_rows=2).orderBy("province_state").collect()
    assert plain == spread
    plain = agg.country_summary(fact).orderBy("country_region").collect()
    assert plain == agg.country_summary(fact, one_task_rows=2).orderBy("country_region").collect()


def test_hot_location_plan_uses_blocks(spark, fact):
    from almanac.operators.series import SeriesMetrics, with_series

    metrics = SeriesMetrics(previous={"prev": "confirmed_cases"}, trailing_mean={"mean": "confirmed_cases"})
    rows = fact.select("province_state", "report_date", "_source_table", "confirmed_cases")
    split = with_series(rows, ["province_state"], ["report_date", "_source_table"], metrics, hot_rows=5)
    plain = with_series(rows, ["province_state"], ["report_date", "_source_table"], metrics, one_row_per_day=True)
    assert "_block" in simple_plan(split)
    assert split.exceptAll(plain).count() == 0 == plain.exceptAll(split).count()


def test_a_question_about_a_date_reads_its_year(fact):
    day = fact.agg({"report_date": "max"}).first()[0]
    plan = plan_of(adhoc.countries_on(fact, day))
    assert "PartitionFilters: [isnotnull(report_year" in plan and "(report_year#" in plan
    assert "EqualTo(report_date" in plan


def test_all_column_tests_are_one_shuffle_of_values(spark):
    tests = [quality.unique("l_orderkey"), quality.unique("l_shipdate"), quality.not_null("l_tax")]
    rows = quality.run_tests({"lineitem": trade.table(spark, SF_DIR, "lineitem")}, {"lineitem": tests})
    assert simple_plan(rows).count("FileScan parquet") == 1


def test_the_latest_date_comes_from_footers(spark, fact):
    from almanac.operators.latest import _maximum, stored_maximum
    from almanac.plans.fact import FACT_FOLDERS
    from almanac.sources.stage import root_of

    path = root_of(fact, FACT_FOLDERS)
    plan = simple_plan(_maximum(spark, path, "report_date"))
    assert "PushedAggregation: [MAX(report_date)]" in plan and "BatchScan" in plan
    day = stored_maximum(spark, path, "report_date")
    assert day == fact.agg({"report_date": "max"}).first()[0]
    snapshot = adhoc.latest_snapshot(fact, path)
    plan = plan_of(snapshot)
    assert "PartitionFilters: [isnotnull(report_year" in plan and "EqualTo(report_date" in plan and "Subquery" not in plan
    assert sorted(map(str, snapshot.collect())) == sorted(map(str, adhoc.latest_snapshot(fact).collect()))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
