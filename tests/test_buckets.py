"""Bucketed tables: no shuffle by their columns, even splits otherwise, nothing left in the catalog."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from almanac.operators.series import SeriesMetrics, with_series
from almanac.plans import fact as fact_plan
from almanac.plans import trade
from almanac.queries import QUERIES
from almanac.sources.buckets import Buckets, buckets_by, open_buckets, write_buckets
from almanac.sources.stage import stage, stage_in_buckets
from almanac.sources.warehouse import Warehouse
from test_plans import SF_DIR, simple_plan

METRICS = SeriesMetrics(previous={"prev": "o_totalprice"}, trailing_mean={"mean": "o_custkey"})
BY = ["o_orderdate", "o_orderkey"]


@pytest.fixture(scope="module")
def orders(spark):
    return trade.table(spark, SF_DIR, "orders")


@pytest.fixture(scope="module")
def held(spark, orders):
    return stage_in_buckets(orders, "orders", buckets_by(spark, "o_custkey"))


def names(spark):
    return {t.name for t in spark.catalog.listTables("default") if not t.isTemporary}


def test_rows_come_back_and_no_name_stays(spark, orders, held):
    assert held.exceptAll(orders).isEmpty() and orders.exceptAll(held).isEmpty()
    assert held.schema.simpleString() == orders.schema.simpleString()
    assert not any(name.startswith("bucketed_") for name in names(spark))


def test_series_groups_and_joins_by_the_columns_do_not_shuffle(spark, orders, held):
    series = with_series(held, ["o_custkey"], BY, METRICS, one_row_per_day=True)
    assert "Exchange" not in simple_plan(series) and "Window [" in simple_plan(series)
    plain = with_series(orders, ["o_custkey"], BY, METRICS, one_row_per_day=True)
    assert "Exchange" in simple_plan(plain)
    assert series.exceptAll(plain).isEmpty() and plain.exceptAll(series).isEmpty()
    groups = held.groupBy("o_custkey", "o_orderstatus").count()
    assert "Exchange" not in simple_plan(groups)
    join = held.select("o_custkey", "o_orderkey").join(held.groupBy("o_custkey").count().hint("merge"), "o_custkey")
    assert "Exchange" not in simple_plan(join) and "SortMergeJoin" in simple_plan(join)


def test_a_query_without_use_for_buckets_reads_even_splits(held):
    plan = held.where("o_totalprice > 1e5").select("o_orderkey", "o_custkey")._jdf.queryExecution().toString()
    assert "Bucketed: false (disabled by query planner)" in plan and "PushedFilters: [IsNotNull(o_totalprice)" in plan


def test_few_files_and_a_hot_bucket_in_several(spark, tmp_path):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 97).alias("k"), "id", F.sha2(F.col("id").cast("string"), 512).alias("pad"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.1"}
    kept = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        write_buckets(rows, f"{tmp_path}/t", Buckets(("k",), 8))
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    numbers = [int(re.search(r"_(\d{5})\.", f.name)[1]) for f in (tmp_path / "t").glob("*.parquet")]
    hot = spark.range(1).select(F.pmod(F.hash(F.lit(-1).cast("bigint")), F.lit(8))).first()[0]
    assert numbers.count(hot) > 1
    assert len(numbers) - numbers.count(hot) < 8 * 8, "files grow with buckets, not with tasks times buckets"
    back = open_buckets(spark, f"{tmp_path}/t", rows.schema, Buckets(("k",), 8))
    counts = back.groupBy("k").count()
    assert "Exchange" not in simple_plan(counts)
    assert {r.k: r["count"] for r in counts.collect()} == {r.k: r["count"] for r in rows.groupBy("k").count().collect()}


def test_odd_names_empty_tables_nulls_and_repeats(spark, tmp_path):
    odd = spark.createDataFrame([(None, "x"), (None, "x"), ("a b", None)], "`a key` string, `_bucket_` string")
    path = f"{tmp_path}/it's here"
    buckets = Buckets(("a key",), 3, ("_bucket_",))
    write_buckets(odd, path, buckets)
    back = open_buckets(spark, path, odd.schema, buckets)
    assert sorted(map(str, back.collect())) == sorted(map(str, odd.collect()))
    write_buckets(odd.limit(0), f"{tmp_path}/none", buckets)
    assert open_buckets(spark, f"{tmp_path}/none", odd.schema, buckets).count() == 0


def test_two_feeds_in_buckets_make_the_fact_without_a_shuffle(spark):
    us, elsewhere = trade.cleaned_reports(spark, SF_DIR)
    by = buckets_by(spark, *fact_plan.PLACE)
    bucketed = fact_plan.fact_daily(stage_in_buckets(us, "us", by), stage_in_buckets(elsewhere, "elsewhere", by), one_row_per_day=True)
    plain = fact_plan.fact_daily(stage(us, "us"), stage(elsewhere, "elsewhere"), one_row_per_day=True)
    assert "Exchange" not in simple_plan(bucketed) and simple_plan(plain).count("Exchange") == 2
    columns = [c for c in fact_plan.FACT_COLUMNS if not c.startswith(("_staged", "_fact"))]
    assert bucketed.select(columns).exceptAll(plain.select(columns)).isEmpty() and bucketed.count() == plain.count()


@pytest.mark.parametrize("name", ["lag_by_location", "rolling_7row", "daily_delta", "pct_change", "trend_label"])
def test_series_queries_read_buckets(spark, name):
    plan = simple_plan(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in plan and "Window [" in plan


def test_a_bucketed_warehouse_table_is_replaced_under_a_reader(spark, tmp_path, orders):
    warehouse, name = Warehouse(spark, str(tmp_path)), f"t_{uuid.uuid4().hex}"
    by = buckets_by(spark, "o_custkey", sort_by=("o_orderkey",))
    warehouse.write("gold", name, orders, buckets=by)
    before = warehouse.read("gold", name)
    assert "Exchange" not in simple_plan(before.groupBy("o_custkey").count())
    warehouse.write("gold", name, orders.limit(10), buckets=by)
    assert before.count() == orders.count() and warehouse.read("gold", name).count() == 10
    assert spark.table(f"gold.{name}").count() == 10
    assert "Exchange" not in simple_plan(spark.sql(f"SELECT o_custkey, COUNT(*) FROM gold.{name} GROUP BY o_custkey"))
    spark.sql(f"DROP TABLE gold.{name}")
    warehouse.attach()
    assert "Exchange" not in simple_plan(spark.table(f"gold.{name}").groupBy("o_custkey").count())
    warehouse.write("gold", name, orders, sort_by="o_orderkey")  # from here on without buckets
    assert warehouse.read("gold", name).count() == orders.count() == spark.table(f"gold.{name}").count()
    with pytest.raises(ValueError, match="folders or buckets"):
        warehouse.write("gold", name, orders, partition_by=["o_orderstatus"], buckets=by)
