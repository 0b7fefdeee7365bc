"""Report files through bronze, silver, fact, summaries, marts and reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from almanac.__main__ import main
from almanac.operators.union import union_drifting
from almanac.plans import fact as fact_plan
from almanac.plans import silver
from almanac.plans.column_tests import MODEL_TESTS
from almanac.plans.registry import MODELS, feed_rows, run_models, select_models, test_models
from almanac.sources.feeds import FEEDS
from almanac.sources.files import qualified
from almanac.sources.reports import ingest_reports
from almanac.sources.warehouse import Warehouse
from report_files import write_landing

DAY = dt.date


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return str(write_landing(tmp_path_factory.mktemp("landing")))


@pytest.fixture(scope="module")
def warehouse(spark, landing, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    for feed in ("global", "us"):
        ingest_reports(spark, landing, feed, f"{wh.root}/bronze")
    assert set(run_models(wh)) == set(MODELS)
    return wh


def series(warehouse, state, *columns):
    rows = warehouse.read("gold", "fct_covid_daily").filter((F.col("province_state") == state) & (F.col("data_source") == "US"))
    return [tuple(r) for r in rows.orderBy("report_date").select(*columns).collect()]


def test_silver_values(warehouse):
    world = warehouse.read("silver", "silver_covid_cases_global")
    assert world.columns == [
        "fips_code", "admin2", "province_state", "country_region", "location_key", "latitude", "longitude",
        "confirmed_cases", "total_deaths", "total_recovered", "active_cases", "incident_rate_per_100k",
        "case_fatality_ratio_pct", "last_updated_at", "_staged_at", "_source_table",
    ]
    peru = world.filter("country_region = 'Peru'").orderBy("_source_table", "province_state").collect()
    first = peru[0]
    assert (first.confirmed_cases, first.latitude, first.incident_rate_per_100k, first.case_fatality_ratio_pct) == (
        7, None, None, None,
    )
    assert [r.case_fatality_ratio_pct for r in peru[1:]] == [None, 0.0, 100.0, None, None]
    chile = world.filter("country_region = 'Chile'").collect()[0]
    assert (chile.province_state, chile.total_recovered) == (None, 0)
    assert world.filter("_source_table = 'bronze.global_02_01_2020'").collect()[0].last_updated_at == dt.datetime(
        2020, 2, 1, 1, 52
    )
    us = warehouse.read("silver", "silver_covid_cases_us")
    guam = us.filter("province_state = 'Guam'").collect()[0]
    assert (guam.country_region, guam.iso3_code, guam.latitude, guam.fips_code) == ("US", None, None, 48)
    assert us.filter("_staged_at IS NULL").count() == 0
    assert us.columns[19:] == ["last_updated_at", "snapshot_date", "_staged_at", "_source_table"]


def test_fact_series(warehouse):
    assert series(
        warehouse, "Ohio", "report_date", "daily_new_cases", "pct_change_cases", "has_new_cases", "case_trend",
        "confirmed_cases_7day_avg",
    ) == [
        (DAY(2020, 4, 12), 0, None, False, "Unknown", 50.0),
        (DAY(2020, 4, 13), 10, 20.0, True, "Increasing", 55.0),
        (DAY(2020, 4, 15), -5, -8.33, False, "Decreasing", 55.0),
    ]
    assert [r[0] for r in series(warehouse, "Texas", "case_trend")] == ["Unknown", "Stable", "Increasing"]
    # mean over the row and up to six rows before it
    assert [r[0] for r in series(warehouse, "Iowa", "confirmed_cases_7day_avg")] == [
        100.0, 150.0, 200.0, 250.0, 300.0, 350.0, 400.0, 500.0, 600.0,
    ]
    assert series(warehouse, "Guam", "test_positivity_rate_pct", "calculated_cfr_pct", "severity_category")[0] == (
        None, None, "Very Low",
    )
    assert series(warehouse, "Utah", "report_year", "week_of_year", "day_of_week") == [
        (2022, 52, "Saturday "), (2022, 52, "Saturday "),
    ]


def test_fact_rows_of_the_global_feed(warehouse):
    rows = warehouse.read("gold", "fct_covid_daily").filter("data_source = 'Global'")
    assert set(rows.columns) == set(fact_plan.FACT_COLUMNS) and len(rows.columns) == 48
    countries = {r[0] for r in rows.select("country_region").distinct().collect()}
    assert countries == {"China", "Japan", "Italy", "Peru", "Chile", "Canada", "Fiji"}
    fiji = rows.filter("country_region = 'Fiji'").collect()[0]
    assert fiji.report_date is None and fiji.location_name == "Fiji" and fiji.day_of_week is None
    canada = rows.filter("country_region = 'Canada'").orderBy("_source_table").collect()
    assert canada[0].fact_key == canada[1].fact_key
    assert [(r.confirmed_cases, r.daily_new_cases, r.daily_new_tests) for r in canada] == [(52143, 0, 0), (52398, 255, 0)]


def test_same_week_of_a_calendar_year_is_one_group(warehouse):
    rows = warehouse.read("gold", "mart_covid_trends").filter("province_state = 'Utah'").orderBy("report_date")
    assert [(r.weekly_total_new_cases, r.weekly_peak_new_cases, r.weekly_avg_new_cases, r.trend_strength)
            for r in rows.collect()] == [(4000, 4000, 2000.0, "Minimal"), (4000, 4000, 2000.0, "Sharp")]


def test_summaries(warehouse):
    days = warehouse.read("gold", "agg_daily_summary").orderBy("snapshot_date").limit(3).collect()
    assert [(r.total_confirmed_cases, r.new_cases_today, r.case_trend, r.states_reporting) for r in days] == [
        (150, 0, "Stable", 3), (160, 10, "Rising", 3), (185, 25, "Rising", 3),
    ]
    states = {r.province_state: r for r in warehouse.read("gold", "agg_state_summary").collect()}
    assert states["Guam"].national_rank_incident_rate == 1 and states["Guam"].avg_incident_rate_per_100k is None
    assert states["Utah"].national_rank_cases == 1 and states["Utah"].cases_percentile == 1.0
    assert states["Ohio"].total_confirmed_cases == 60 and states["Ohio"].days_reporting == 3
    countries = {r.country_region: r for r in warehouse.read("gold", "agg_country_summary").collect()}
    assert countries["China"].total_confirmed_cases == 444 + 7153 + 68135
    assert countries["China"].provinces_reporting == 2 and countries["Fiji"].data_points == 1


def test_top_countries(warehouse):
    mart = warehouse.read("gold", "mart_top_countries").orderBy("rank_by_cases").collect()
    # Canada's two rows share their date and are added; Fiji has no date
    assert [(r.country_region, r.total_confirmed_cases, r.impact_tier) for r in mart] == [
        ("Chile", 113628, "Highest"), ("Canada", 104541, "Very High"), ("China", 68135, "Very High"),
        ("Italy", 59138, "High"), ("US", 9000, "High"),
    ]
    assert {r.occurrence_frequency for r in mart} == {1}
    report = warehouse.read("gold", "rpt_top_countries_by_cases")
    assert "severity_tier" in report.columns and "unique_provinces" in report.columns


def test_correlations(warehouse):
    mart = {r.metric_pair: r for r in warehouse.read("gold", "mart_correlation_metrics").collect()}
    constant = mart["Testing Rate vs Incident Rate"]
    assert constant.correlation_coefficient is None and constant.correlation_direction == "None"
    assert constant.sample_size == 17
    report = warehouse.read("gold", "rpt_correlation_analysis")
    assert "r_squared" not in report.columns and report.count() == 5


def test_declared_tests_report_the_known_faults(warehouse):
    results = test_models(warehouse).collect()
    assert len(results) == 41 == sum(map(len, MODEL_TESTS.values()))
    failed = {(r.model, r.column, r.test): r.failures for r in results if not r.passed}
    assert failed == {
        ("fct_covid_daily", "fact_key", "unique"): 1,
        ("fct_covid_daily", "report_date", "not_null"): 1,
        # pairs with a constant metric
        ("rpt_correlation_analysis", "correlation_coefficient", "not_null"): 3,
        ("mart_correlation_metrics", "correlation_coefficient", "not_null"): 3,
    }


def test_built_tables_answer_sql(spark, warehouse):
    def rows(text):
        return [tuple(r) for r in spark.sql(text).collect()]

    assert rows("""SELECT country_region, count(DISTINCT report_date), sum(confirmed_cases) AS total
        FROM gold.fct_covid_daily GROUP BY 1 ORDER BY total DESC LIMIT 2""") == [("Chile", 1, 113628), ("Canada", 1, 104541)]
    assert rows("""SELECT country_region, province_state FROM gold.fct_covid_daily
        WHERE report_date = (SELECT max(report_date) FROM gold.fct_covid_daily)""") == [("US", "Utah")]
    assert rows("""SELECT daily_new_cases, case_trend FROM gold.fct_covid_daily
        WHERE province_state = 'Ohio' AND data_source = 'US' ORDER BY report_date""") == [
        (0, "Unknown"), (10, "Increasing"), (-5, "Decreasing"),
    ]
    assert rows("""SELECT report_year, week_of_year, sum(daily_new_cases), count(DISTINCT location_name)
        FROM gold.fct_covid_daily WHERE data_source = 'US' GROUP BY 1, 2 ORDER BY 1, 2""")[-1] == (2022, 52, 4000, 1)
    assert rows("""SELECT corr(confirmed_cases, total_deaths) BETWEEN -1 AND 1 FROM gold.fct_covid_daily
        WHERE data_source = 'US'""") == [(True,)]
    assert rows("SELECT severity_tier FROM gold.rpt_top_countries_by_cases ORDER BY rank_by_cases LIMIT 1") == [("Highest",)]
    assert rows("SELECT count(*) FROM gold.mart_covid_trends WHERE province_state = 'Iowa'") == [(9,)]
    assert len(rows("SELECT new_cases_today FROM gold.agg_daily_summary ORDER BY snapshot_date DESC LIMIT 30")) == 14
    assert rows("SELECT count(*) FROM silver.silver_covid_cases_us WHERE _source_table = 'bronze.us_05_01_2020'") == [(1,)]


def test_selection_by_tags_and_order():
    names = [m.name for m in select_models()]
    assert names.index("silver_covid_cases_us") < names.index("fct_covid_daily") < names.index("mart_top_countries")
    assert {m.name for m in select_models(["gold", "mart"])} == {
        "mart_top_countries", "mart_covid_trends", "mart_correlation_metrics",
    }
    assert select_models(["silver", "mart"]) == []
    assert [m.name for m in select_models(names=["fct_covid_daily"])] == ["fct_covid_daily"]
    with pytest.raises(ValueError, match="no such"):
        select_models(names=["fct"])


def test_first_failure_stops_a_run(spark, tmp_path):
    empty = Warehouse(spark, str(tmp_path))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_models(empty, ["fact"])
    with pytest.raises(FileNotFoundError):
        run_models(empty, ["silver"])
    assert not (tmp_path / "gold").exists()


def test_a_relative_root(spark):
    root = qualified(spark, "some/root/")
    assert root.startswith("file:/") and root.endswith("/some/root")


def test_a_failed_write_keeps_the_earlier_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write("gold", "kept", spark.range(3))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        wh.write("gold", "kept", spark.range(4).select((1 / F.col("id")).alias("id")))
    assert wh.read("gold", "kept").count() == 3 == spark.table("gold.kept").count()
    assert wh.tables("gold") == ["kept"]
    wh.write("gold", "kept", spark.range(5).withColumn("part", F.lit("x")), ["part"])
    assert wh.read("gold", "kept").count() == 5 == spark.table("gold.kept").count()


def test_tables_of_an_earlier_session_are_found(spark, warehouse):
    spark.sql("DROP TABLE IF EXISTS gold.fct_covid_daily")  # files stay
    assert not spark.catalog.tableExists("gold.fct_covid_daily")
    warehouse.attach()
    rows = warehouse.read("gold", "fct_covid_daily").count()
    assert rows > 0 and spark.table("gold.fct_covid_daily").count() == rows


def test_typed_bronze_tables_join_the_feed(spark, warehouse):
    seed = spark.createDataFrame(
        [(7.5, "Ohio", DAY(2023, 1, 1), float("nan"))],
        "confirmed double, province_state string, date date, testing_rate double",
    )
    other = spark.createDataFrame([(1,)], "confirmed int")
    warehouse.write("bronze", "us_2023", seed)
    warehouse.write("bronze", "us_more of +2023", seed.withColumn("province_state", F.lit("Utah")))
    warehouse.write("bronze", "usage", other)  # not of the feed
    rows = silver.silver_us(feed_rows(warehouse, "us"))
    got = rows.filter("snapshot_date = '2023-01-01'").orderBy("province_state").collect()
    assert [(r.province_state, r.confirmed_cases, r.testing_rate_per_100k, r["_source_table"]) for r in got] == [
        ("Ohio", 8, None, "bronze.us_2023"), ("Utah", 8, None, "bronze.us_more of +2023"),
    ]
    assert rows.count() == warehouse.read("silver", "silver_covid_cases_us").count() + 2
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2  # scans


def test_typed_cells_are_cast_without_text(spark):
    columns = {c: t for c, t in FEEDS["us"].items()}
    schema = ", ".join(f"`{c}` {'double' if t in ('bigint', 'double') else t}" for c, t in columns.items())
    row = {c: 2.5 if t == "bigint" else float("nan") if t == "double" else None for c, t in columns.items()}
    raw = spark.createDataFrame([tuple(row.values())], schema).withColumn("_source", F.lit("bronze.us_x"))
    got = silver.silver_us(raw).collect()[0]
    assert (got.confirmed_cases, got.incident_rate_per_100k, got.latitude, got.country_region) == (3, None, None, "US")


def test_missing_column_is_an_error(spark):
    raw = union_drifting({"t": spark.createDataFrame([("1",)], "confirmed string")})
    with pytest.raises(ValueError, match="lacks"):
        silver.silver_global(raw)


def test_split_location_gives_the_same_fact(spark, warehouse):
    us, world = warehouse.read("silver", "silver_covid_cases_us"), warehouse.read("silver", "silver_covid_cases_global")
    stable = [c for c in fact_plan.FACT_COLUMNS if c != "_fact_created_at"]
    plain, split = (
        sorted(map(str, fact_plan.fact_daily(us, world, hot_rows=n).select(stable).collect())) for n in (10**6, 1)
    )
    assert plain == split


def test_command_line(spark, landing, tmp_path, capsys):
    root = ["--warehouse", str(tmp_path / "wh")]
    assert main(["ingest", "--landing", landing, *root]) == 1  # the landing has faults, which are counted
    assert "1 x row left out, row longer than the header" in capsys.readouterr().out
    assert main(["run", "--tags", "silver", *root]) == 0
    assert main(["run", "--tags", "gold,fact", *root]) == 0
    assert "fct_covid_daily" in capsys.readouterr().out
    assert main(["test", "--models", "fct_covid_daily", *root]) == 1
    assert "FAIL 1 fct_covid_daily.fact_key unique" in capsys.readouterr().out
