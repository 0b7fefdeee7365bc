"""The ingest layer over a whole table: files with drifting headers, faults, reloads, seeds, bronze read back with types."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.plans.registry import feed_rows
from almanac.plans.silver import silver_global
from almanac.plans.trade import table
from almanac.queries.registry import query
from almanac.sources.bronze import Bronze
from almanac.sources.feeds import FEEDS, typed_cell
from almanac.sources.files import create_empty, move_only_file, subfolders
from almanac.sources.reports import ingest_reports, read_bronze
from almanac.sources.seeds import read_seeds
from almanac.sources.stage import stage, stage_folder
from almanac.sources.warehouse import Warehouse


def _event_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Events as report cells, one file per day."""
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("fips"),
        F.col("event_type").alias("province_state"),
        F.col("value").cast("string").alias("incident_rate"),
        F.col("user_id").cast("string").alias("confirmed"),
        F.day("ts").alias("_day"),
        F.date_format("ts", "MM-dd-yyyy'.csv'").alias("_file"),
    )


def _changed(cells: DataFrame) -> DataFrame:
    """The files of even days, with other counts."""
    return cells.filter(F.col("_day") % 2 == 0).withColumn("confirmed", (F.col("confirmed").cast("bigint") + 1000).cast("string"))


@query("bronze_reload", """
SELECT event_id AS fips, event_type AS province_state, value AS incident_rate,
  CASE WHEN day(ts) % 2 = 0 THEN user_id + 1000 ELSE user_id END AS confirmed,
  CAST(NULL AS DOUBLE) AS lat, CAST(ts AS DATE) AS file_date, 'bronze.global_' || strftime(ts, '%m_%d_%Y') AS _source
FROM events""")
def _bronze_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Events as report cells, one file per day; the files of even days are loaded a second time, changed."""
    cells = _event_cells(spark, sf)
    bronze = Bronze(spark, f"{stage_folder(spark)}/bronze-{uuid.uuid4().hex}", "global")
    bronze.load(cells.drop("_day"))
    bronze.load(_changed(cells).drop("_day"))

    names = ["fips", "province_state", "incident_rate", "confirmed", "lat"]
    typed = [typed_cell(c, FEEDS["global"][c]).alias(c) for c in names]
    return bronze.read().select(*typed, "file_date", "_source")


@query("reload_under_reader", """
SELECT reader, file_date, COUNT(*) AS n, CAST(SUM(confirmed) AS BIGINT) AS confirmed FROM (
  SELECT 'began before' AS reader, CAST(ts AS DATE) AS file_date, user_id AS confirmed FROM events
  UNION ALL
  SELECT 'began after', CAST(ts AS DATE), CASE WHEN day(ts) % 2 = 0 THEN user_id + 1000 ELSE user_id END FROM events
) GROUP BY ALL""")
def _reload_under_reader(spark: SparkSession, sf: str) -> DataFrame:
    """Readers that began before and after a reload of the files of even days; the first still sees what was there."""
    cells = _event_cells(spark, sf)
    bronze = Bronze(spark, f"{stage_folder(spark)}/bronze-{uuid.uuid4().hex}", "global")
    bronze.load(cells.drop("_day"))
    before = bronze.read(["confirmed"])
    bronze.load(_changed(cells).drop("_day"))
    bronze.clean(keep_hours=1)
    readers = before.withColumn("reader", F.lit("began before")).unionByName(bronze.read(["confirmed"]).withColumn("reader", F.lit("began after")))
    return readers.groupBy("reader", "file_date").agg(F.count("*").alias("n"), F.sum(F.col("confirmed").cast("bigint")).alias("confirmed"))


@query("rebuild_under_reader", """
SELECT 'began before' AS reader, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'began after', o_orderpriority, COUNT(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""")
def _rebuild_under_reader(spark: SparkSession, sf: str) -> DataFrame:
    """The same for a table that is built twice."""
    warehouse = Warehouse(spark, f"{stage_folder(spark)}/rebuilt-{uuid.uuid4().hex}")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    warehouse.write("gold", "orders_twice", orders, ["o_orderstatus"], "o_orderkey")
    before = warehouse.read("gold", "orders_twice")
    warehouse.write("gold", "orders_twice", orders.where("o_orderstatus = 'F'"), ["o_orderstatus"], "o_orderkey")
    after = warehouse.read("gold", "orders_twice")
    readers = before.withColumn("reader", F.lit("began before")).unionByName(after.withColumn("reader", F.lit("began after")))
    return readers.groupBy("reader", "o_orderpriority").agg(F.count("*").alias("n"))


# Report files from the order book, one per month, under two headers: months of even number lack some
# columns and write others differently. Cells are those of SQL below.
_SHORT = {
    "Province/State": "province", "Country/Region": "status", "Last Update": "us_time", "Confirmed": "confirmed",
    "Deaths": "deaths", "Recovered": "recovered",
}
_LONG = {
    "FIPS": "key", "Admin2": "clerk", "Province_State": "province", "Country_Region": "status", "Last_Update": "iso_time",
    "Lat": "zero", "Long_": "key", "Confirmed": "confirmed", "Deaths": "deaths", "Recovered": "recovered", "Active": "active",
    "Combined_Key": "clerk", "Incident_Rate": "price", "Case_Fatality_Ratio": "ratio",
}


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    date, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    return table(spark, sf, "orders").where("o_orderdate IS NOT NULL").select(
        key.alias("key"), F.col("o_orderpriority").alias("province"), F.col("o_orderstatus").alias("status"),
        F.date_format(date, "M/d/yyyy '17:00'").alias("us_time"), F.date_format(date, "yyyy-MM-dd '08:30:00'").alias("iso_time"),
        F.col("o_custkey").alias("confirmed"), (key % 7).alias("deaths"), F.when(key % 5 != 0, key % 11).alias("recovered"),
        F.lit("1.0").alias("active"), F.concat(F.lit('no, '), F.col("o_custkey").cast("string")).alias("clerk"), F.lit("0").alias("zero"),
        F.col("o_totalprice").alias("price"), (key % 150).alias("ratio"),
        (F.month(date) % 2 == 0).alias("_short"), F.date_format(date, "MM-'01'-yyyy'.csv'").alias("_file"),
    )


def _write_files(cells: DataFrame, folder: str) -> None:
    """CSV files under the names in `_file`, each written by one task with the header of its month."""
    spark = cells.sparkSession
    for short, header in ((True, _SHORT), (False, _LONG)):
        own = cells.where(F.col("_short") == short).select(*[F.col(c).cast("string").alias(name) for name, c in header.items()], "_file")
        written = f"{folder}-{uuid.uuid4().hex}"
        own.withColumnRenamed("_file", "file").repartition("file").write.partitionBy("file").option("header", True).csv(written)
        for name in subfolders(spark, written):
            move_only_file(spark, f"{written}/{name}", f"{folder}/{name.removeprefix('file=')}", ".csv")


def _loaded(spark: SparkSession, sf: str, change=lambda cells: cells) -> tuple[str, DataFrame]:
    """Root of a bronze dataset that was loaded from such files, and the faults of the load."""
    root = f"{stage_folder(spark)}/landing-{uuid.uuid4().hex}"
    _write_files(change(_cells(spark, sf)), f"{root}/files/global")
    return root, ingest_reports(spark, f"{root}/files", "global", f"{root}/bronze")


_CLEANED = """
SELECT CASE WHEN month(day) % 2 = 1 THEN o_orderkey END AS fips_code, CASE WHEN month(day) % 2 = 1 THEN 'no, ' || o_custkey END AS admin2,
  o_orderpriority AS province_state, o_orderstatus AS country_region, CAST(o_custkey AS BIGINT) AS confirmed_cases,
  CAST(o_orderkey % 7 AS BIGINT) AS total_deaths,
  CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 11 ELSE 0 END AS BIGINT) AS total_recovered,
  CAST(CASE WHEN month(day) % 2 = 1 THEN 1 ELSE 0 END AS BIGINT) AS active_cases,
  CASE WHEN month(day) % 2 = 1 AND o_orderkey <> 0 THEN CAST(o_orderkey AS DOUBLE) END AS longitude,
  CASE WHEN month(day) % 2 = 1 THEN o_totalprice END AS incident_rate_per_100k,
  CASE WHEN month(day) % 2 = 1 AND o_orderkey % 150 <= 100 THEN CAST(o_orderkey % 150 AS DOUBLE) END AS case_fatality_ratio_pct,
  CAST(day AS TIMESTAMP) + CASE WHEN month(day) % 2 = 1 THEN INTERVAL 510 MINUTE ELSE INTERVAL 1020 MINUTE END AS last_updated_at,
  'bronze.global_' || strftime(day, '%m_01_%Y') AS _source_table
FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders) WHERE day IS NOT NULL"""
_CLEANED_COLUMNS = [
    "fips_code", "admin2", "province_state", "country_region", "confirmed_cases", "total_deaths", "total_recovered", "active_cases",
    "longitude", "incident_rate_per_100k", "case_fatality_ratio_pct", "last_updated_at", "_source_table",
]


@query("csv_ingest", _CLEANED)
def _csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Files with two headers through bronze into the cleaned table."""
    root, _ = _loaded(spark, sf)
    return silver_global(read_bronze(spark, f"{root}/bronze", "global")).select(*_CLEANED_COLUMNS)


@query("ingest_faults", """
SELECT strftime(day, '%m-01-%Y') || '.csv' AS file, left_out, "column", cell, COUNT(*) AS n FROM (
  SELECT CAST(o_orderdate AS DATE) AS day, 'row' AS left_out, 'confirmed' AS "column", 'many' AS cell
  FROM orders WHERE o_orderkey % 50 = 0 AND o_orderdate IS NOT NULL
  UNION ALL
  SELECT CAST(o_orderdate AS DATE), 'cell', 'last_update', 'soon' FROM orders
  WHERE o_orderkey % 50 = 1 AND month(o_orderdate) % 2 = 1
) GROUP BY ALL""")
def _ingest_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Every fiftieth row has a count that is none, others an odd time; what the load kept of that."""
    key = F.col("key") % 50
    _, faults = _loaded(spark, sf, lambda cells: cells.withColumns({
        "confirmed": F.when(key == 0, F.lit("many")).otherwise(F.col("confirmed").cast("string")),
        "iso_time": F.when(key == 1, F.lit("soon")).otherwise(F.col("iso_time")),
    }))
    return faults.groupBy("file", "left_out", "column", "cell").agg(F.count("*").alias("n"))


@query("ingest_reload_empty", f"SELECT _source_table, COUNT(*) AS n FROM ({_CLEANED}) WHERE month(last_updated_at) % 2 = 1 GROUP BY ALL")
def _ingest_reload_empty(spark: SparkSession, sf: str) -> DataFrame:
    """The files of even months are loaded a second time with their header alone: their rows go, the others stay."""
    root, _ = _loaded(spark, sf)
    again = f"{root}/again/global"
    short = _cells(spark, sf).where("_short").select("_file").distinct()
    written = f"{again}-{uuid.uuid4().hex}"
    short.select(F.lit(",".join(_SHORT)).alias("value"), F.col("_file").alias("file")).repartition("file").write.partitionBy("file").text(written)  # one header line
    for name in subfolders(spark, written):
        move_only_file(spark, f"{written}/{name}", f"{again}/{name.removeprefix('file=')}", ".txt")
    ingest_reports(spark, f"{root}/again", "global", f"{root}/bronze")
    return read_bronze(spark, f"{root}/bronze", "global").groupBy(F.col("_source").alias("_source_table")).agg(F.count("*").alias("n"))


@query("seed_tables", """
SELECT 'geo_nation' AS seed, CAST(n_nationkey AS BIGINT) AS key, n_name AS name FROM nation
UNION ALL SELECT 'region', CAST(r_regionkey AS BIGINT), r_name FROM region
UNION ALL SELECT 'book_customer', CAST(c_custkey AS BIGINT), c_name FROM customer
UNION ALL SELECT 'book_supplier', CAST(s_suppkey AS BIGINT), s_name FROM supplier""")
def _seed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Hand-kept tables as CSV, in folders and as parts written by several tasks, read back under their names with inferred types."""
    seeds = _seeds(spark, sf)
    key = {"geo_nation": "n_nation", "region": "r_region", "book_customer": "c_cust", "book_supplier": "s_supp"}
    parts = [
        seeds[name].select(F.lit(name).alias("seed"), F.col(f"{c}key").cast("bigint").alias("key"), F.col(f"{c[0]}_name").alias("name"))
        for name, c in key.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("seed_types", """
SELECT seed, "column", kind FROM (VALUES ('book_customer', 'c_custkey', 'int'), ('book_customer', 'c_name', 'string'), ('book_customer', 'c_acctbal', 'double'),
  ('book_customer', 'c_nationkey', 'int'), ('book_orders', 'o_orderdate', 'date'), ('book_orders', 'o_big', 'bigint'), ('book_orders', 'o_late', 'boolean'),
  ('book_orders', 'o_mixed', 'string')) AS t(seed, "column", kind)
WHERE (SELECT COUNT(*) FROM customer) > 0 AND (SELECT COUNT(*) FROM orders) > 0""")
def _seed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Types of some seed columns: the narrowest that holds all cells of all parts."""
    seeds = _seeds(spark, sf)
    asked = {"book_customer": ["c_custkey", "c_name", "c_acctbal", "c_nationkey"], "book_orders": ["o_orderdate", "o_big", "o_late", "o_mixed"]}
    rows = [(seed, c, seeds[seed].schema[c].dataType.simpleString()) for seed, columns in asked.items() for c in columns]
    return spark.createDataFrame(rows, "seed string, column string, kind string")


def _seeds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Seeds cut from the tables: two small ones as single files, the others as folders of part files."""
    root = f"{stage_folder(spark)}/seeds-{uuid.uuid4().hex}"
    for name, path in (("nation", "geo/nation.csv"), ("region", "region.csv")):
        written = f"{root}-{name}"
        table(spark, sf, name).coalesce(1).write.option("header", True).csv(written)
        move_only_file(spark, written, f"{root}/{path}", ".csv")
    orders = table(spark, sf, "orders").where("o_orderdate IS NOT NULL").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), (F.col("o_orderkey") + F.lit(3_000_000_000)).alias("o_big"),
        (F.col("o_orderkey") % 3 == 0).alias("o_late"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(F.col("o_orderstatus")).alias("o_mixed"))
    for name, rows in (("customer", table(spark, sf, "customer")), ("supplier", table(spark, sf, "supplier")), ("orders", orders)):
        rows.repartition(4).write.option("header", True).csv(f"{root}/book/{name}.csv")
    return read_seeds(spark, root)


#: Tables of the feed, each with one customer group; three kinds of columns.
PREFIX_TABLES = 210


@query("many_tables_by_prefix", f"""
SELECT CAST(c_custkey AS BIGINT) AS confirmed, CASE WHEN part % 3 = 0 THEN c_name END AS province_state,
  CASE WHEN part % 3 = 1 THEN c_mktsegment END AS iso3, CASE WHEN part % 3 = 2 THEN c_acctbal END AS lat, 'bronze.us_' || lpad(CAST(part AS VARCHAR), 3, '0') AS _source
FROM (SELECT *, c_custkey % {PREFIX_TABLES} AS part FROM customer)""")
def _many_tables_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in as many tables as they have groups, with three sets of columns: their schemas are found by one job, their rows by three scans."""
    warehouse = Warehouse(spark, f"{stage_folder(spark)}/many-{uuid.uuid4().hex}")
    groups = stage(table(spark, sf, "customer").withColumn("part", F.col("c_custkey") % PREFIX_TABLES), "groups", ["part"])
    kinds = [[F.col("c_custkey").cast("int").alias("Confirmed"), F.col("c_name").alias("Province/State")],
             [F.col("c_custkey").alias("confirmed"), F.col("c_mktsegment").alias("ISO3")], [F.col("c_custkey").alias("confirmed"), F.col("c_acctbal").alias("lat")]]
    warehouse.write_all("bronze", {f"us_{part:03d}": groups.where(F.col("part") == part).select(*kinds[part % 3]) for part in range(PREFIX_TABLES)})
    return feed_rows(warehouse, "us").select("confirmed", "province_state", "iso3", "lat", "_source")


@query("ingest_empty_files", f"""
SELECT _source_table, COUNT(*) AS n FROM ({_CLEANED}) WHERE month(last_updated_at) % 3 <> 0 GROUP BY ALL
UNION ALL SELECT DISTINCT strftime(CAST(o_orderdate AS DATE), '%m-01-%Y') || '.csv', 0 FROM orders WHERE month(o_orderdate) % 3 = 0""")
def _ingest_empty_files(spark: SparkSession, sf: str) -> DataFrame:
    """The files of every third month have no content: they are faults, the others are loaded."""
    root = f"{stage_folder(spark)}/landing-{uuid.uuid4().hex}"
    cells = _cells(spark, sf)
    third = F.substring("_file", 1, 2).cast("int") % 3 == 0
    _write_files(cells.where(~third), f"{root}/files/global")
    for row in cells.where(third).select("_file").distinct().collect():  # as many as there are months
        create_empty(spark, f"{root}/files/global/{row._file}")
    faults = ingest_reports(spark, f"{root}/files", "global", f"{root}/bronze")
    loaded = read_bronze(spark, f"{root}/bronze", "global").groupBy(F.col("_source").alias("_source_table")).agg(F.count("*").alias("n"))
    return loaded.unionByName(faults.where("reason = 'empty file' AND left_out = 'file'").select(F.col("file").alias("_source_table"), F.lit(0).cast("bigint").alias("n")))


@query("tables_by_prefix", """
SELECT CAST(o_custkey AS BIGINT) AS confirmed, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS province_state,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS iso3,
  CASE WHEN o_orderkey % 2 = 1 THEN 'bronze.us_odd' ELSE 'bronze.us_even' END AS _source
FROM orders""")
def _tables_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables of the feed with different columns and types, found by their prefix; a third only begins alike."""
    warehouse = Warehouse(spark, f"{stage_folder(spark)}/prefix-{uuid.uuid4().hex}")
    orders = table(spark, sf, "orders")
    parts = {
        "us_odd": orders.where("o_orderkey % 2 = 1").select(F.col("o_custkey").cast("int").alias("Confirmed"), F.col("o_orderstatus").alias("Province_State")),
        "us_even": orders.where("o_orderkey % 2 = 0").select(F.col("o_custkey").cast("bigint").alias("confirmed"), F.col("o_orderpriority").alias("iso3")),
        "usage": orders.select("o_orderkey"),
    }
    for name, rows in parts.items():
        warehouse.write("bronze", name, rows)
    return feed_rows(warehouse, "us").select("confirmed", "province_state", "iso3", "_source")
