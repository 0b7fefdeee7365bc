"""The daily-report tables for an order book: one location per nation, one report per order date.

Quantities shipped take the place of case counts: running totals per nation, by return
flag, with daily rates. The result has the columns of the two cleaned report tables, so
the fact and everything above it run on it unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from almanac.functions import clean
from almanac.operators.quality import ColumnTest, watched
from almanac.plans.column_tests import MODEL_TESTS
from almanac.plans.fact import FACT_FOLDERS, FACT_SORT, PLACE, combine_feeds, fact_daily
from almanac.sources.buckets import Buckets, buckets_by
from almanac.sources.files import files_of
from almanac.sources.stage import stage, stage_in_buckets, still_there

# Written tables of this process, by application, input folder and state of the input tables.
_built: dict[tuple, DataFrame] = {}
_failed: dict[tuple, dict[ColumnTest, int]] = {}
_INPUTS = ["lineitem", "orders", "customer", "nation", "region"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def hundredths(column: str) -> Column:
    """An amount with two decimals as a whole number: such sums are exact in any order."""
    return F.floor(F.col(column) * 100 + 0.5)


def nation_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums per nation. Lines are combined per order before they meet the orders."""
    quantity = F.col("l_quantity").cast("bigint")
    flagged = lambda flag: F.when(F.col("l_returnflag") == flag, quantity).otherwise(F.lit(0))
    per_order = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(quantity).alias("all_units"),
        F.sum(flagged("R")).alias("r_units"),
        F.sum(flagged("A")).alias("a_units"),
        F.sum(flagged("N")).alias("n_units"),
        F.count("*").alias("lines"),
        F.count_if(F.col("l_returnflag") == "A").alias("a_lines"),
        F.sum(hundredths("l_discount")).alias("discount"),
        F.sum(hundredths("l_tax")).alias("tax"),
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey", F.col("o_orderdate").cast("date").alias("day"))
    )
    sums = ["all_units", "r_units", "a_units", "n_units", "lines", "a_lines", "discount", "tax"]
    daily = orders.join(per_order, "o_orderkey").groupBy("c_nationkey", "day").agg(*[F.sum(c).alias(c) for c in sums])
    # names join the sums, so that no order carries them through a shuffle
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return daily.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey", "n_name", "r_name", "day", *sums
    )


def cleaned_reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two cleaned tables (us, global); AMERICA plays the part of the US feed."""
    # One row per nation and day. The region is part of the key so that each feed's filter
    # on it moves below the window, to the scan.
    so_far = Window.partitionBy("r_name", "n_nationkey").orderBy(F.col("day").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = {
        "confirmed_cases": "all_units", "total_deaths": "r_units", "total_recovered": "a_units",
        "active_cases": "n_units", "total_test_results": "lines", "people_hospitalized": "a_lines",
    }
    mean = lambda total: F.col(total).cast("double") / F.col("lines").cast("double")
    daily_pct = lambda part, whole: F.lit(100.0) * F.col(part).cast("double") / F.col(whole).cast("double")
    reports = built_nation_days(spark, sf_dir).select(
        "r_name", "day",
        F.col("n_nationkey").cast("bigint").alias("fips_code"),
        F.col("n_name").alias("province_state"),
        F.col("r_name").alias("country_region"),
        clean.zero_to_null(F.col("n_nationkey").cast("double")).alias("latitude"),
        clean.zero_to_null(-F.col("n_nationkey").cast("double")).alias("longitude"),
        *[clean.null_to_zero(F.sum(source).over(so_far)).alias(name) for name, source in running.items()],
        (F.sum("lines").over(so_far) * 20).alias("people_tested"),
        clean.not_below_zero(mean("discount")).alias("incident_rate_per_100k"),
        clean.within_percent(daily_pct("r_units", "all_units")).alias("case_fatality_ratio_pct"),
        clean.not_below_zero(mean("tax")).alias("testing_rate_per_100k"),
        clean.within_percent(daily_pct("a_lines", "lines")).alias("hospitalization_rate_pct"),
        clean.within_percent(daily_pct("n_units", "all_units")).alias("mortality_rate_pct"),
        F.col("day").cast("timestamp").alias("last_updated_at"),
        F.current_timestamp().alias("_staged_at"),
        F.concat(F.lit("bronze.orders_"), F.date_format("day", "MM_dd_yyyy")).alias("_source_table"),
    )
    us = reports.filter(F.col("r_name") == "AMERICA").withColumns(
        {
            "uid": F.col("fips_code") + 84_000_000,
            "iso3_code": F.lit("USA"),
            "snapshot_date": F.col("day"),
        }
    )
    elsewhere = reports.filter(F.col("r_name") != "AMERICA").withColumn("admin2", F.lit(None).cast("string"))
    return us, elsewhere


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    us, elsewhere = cleaned_reports(spark, sf_dir)
    return fact_daily(us, elsewhere, one_row_per_day=True)


def built_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds, stacked, as a table in buckets by place: series by location read it without a shuffle."""
    return build_once("reports", spark, sf_dir, lambda s, sf: combine_feeds(*cleaned_reports(s, sf)), buckets=buckets_by(spark, *PLACE))


def built_nation_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily sums as a written table: both feeds read it, so the lines are scanned once."""
    return build_once("nation_days", spark, sf_dir, nation_days)


def built_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a written table, built once per application: what marts and reports read."""
    return build_once("fact", spark, sf_dir, fact, list(FACT_FOLDERS), FACT_SORT, MODEL_TESTS["fct_covid_daily"])


def build_once(
    name: str,
    spark: SparkSession,
    sf_dir: str,
    build: Callable[[SparkSession, str], DataFrame],
    partition_by: list[str] | None = None,
    sort_by: str | None = None,
    tests: Sequence[ColumnTest] = (),
    buckets: Buckets | None = None,
) -> DataFrame:
    """The written table, written again when the input tables have changed or its files are gone."""
    key = _key(name, spark, sf_dir)
    if key not in _built or not still_there(_built[key]):
        rows, failed = watched(build(spark, sf_dir), tests)
        _built[key] = stage_in_buckets(rows, name, buckets) if buckets else stage(rows, name, partition_by, sort_by)
        _failed[key] = failed()
    return _built[key]


def failed_when_built(name: str, spark: SparkSession, sf_dir: str) -> dict[ColumnTest, int]:
    """Rows of a table built once that failed its tests, as counted when it was written."""
    return _failed[_key(name, spark, sf_dir)]


def _key(name: str, spark: SparkSession, sf_dir: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, name, tuple(files_of(spark, table_path(sf_dir, t)) for t in _INPUTS))
