"""Column tests over the built tables and over tables that fail them."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.quality import ColumnTest, accepted, not_null, run_tests, unique
from almanac.plans import agg, mart, report, trade
from almanac.plans.column_tests import MODEL_TESTS
from almanac.plans.registry import SILVER_GLOBAL, SILVER_US, run_models, select_models
from almanac.plans.trade import table
from almanac.queries import expected, models
from almanac.queries.registry import on_fact, query
from almanac.sources.stage import stage_folder
from almanac.sources.warehouse import AT_ONCE, Warehouse


def _failures_sql(test: ColumnTest, source: str) -> str:
    c = test.column
    if test.test == "not_null":
        return f"SELECT COUNT(*) FROM {source} WHERE {c} IS NULL"
    if test.test == "unique":
        return f"SELECT COUNT(*) FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
    listed = ", ".join(repr(v) for v in test.values)
    return f"SELECT COUNT(DISTINCT {c}) FROM {source} WHERE {c} NOT IN ({listed})"


def _report_sql(model: str, tests: list[ColumnTest], source: str) -> str:
    rows = [
        f"SELECT '{model}' AS model, '{t.column}' AS \"column\", '{t.test}' AS test, "
        f"({_failures_sql(t, source)}) AS failures"
        for t in tests
    ]
    return " UNION ALL ".join(rows)


def _with_passed(sql: str) -> str:
    return f"SELECT *, failures = 0 AS passed FROM ({sql})"


FACT_NULLS = [not_null("fact_key"), not_null("report_date"), not_null("pct_change_cases"), not_null("iso3_code")]
LINE_UNIQUE = [unique("l_orderkey"), unique("l_shipdate"), unique("l_extendedprice")]
ORDER_VALUES = [
    accepted("o_orderstatus", "F", "O", "P"),
    accepted("o_orderstatus", "F", "O"),
    accepted("o_orderpriority", "1-URGENT", "2-HIGH"),
]


@query("dq_not_null", on_fact(_with_passed(_report_sql("fact", FACT_NULLS, "fact"))))
def _dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return run_tests({"fact": trade.built_fact(spark, sf)}, {"fact": FACT_NULLS})


@query("dq_unique", _with_passed(_report_sql("lineitem", LINE_UNIQUE, "lineitem")))
def _dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return run_tests({"lineitem": table(spark, sf, "lineitem")}, {"lineitem": LINE_UNIQUE})


@query("dq_accepted_values", _with_passed(_report_sql("orders", ORDER_VALUES, "orders")))
def _dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return run_tests({"orders": table(spark, sf, "orders")}, {"orders": ORDER_VALUES})


# published table -> (builder over the fact, check SQL)
_TESTED = {
    "rpt_top_countries_by_cases": (report.top_countries_by_cases, models.TOP_COUNTRIES_REPORT),
    "rpt_covid_trends_over_time": (report.trends_over_time, models.TRENDS_REPORT),
    "rpt_correlation_analysis": (report.correlation_analysis, models.CORRELATION_REPORT),
    "agg_daily_summary": (agg.daily_summary, models.DAILY_SUMMARY),
    "agg_state_summary": (agg.state_summary, models.STATE_SUMMARY),
    "agg_country_summary": (agg.country_summary, models.COUNTRY_SUMMARY),
    "mart_top_countries": (mart.top_countries, models.TOP_COUNTRIES),
    "mart_covid_trends": (mart.trends, models.TRENDS),
    "mart_correlation_metrics": (mart.correlation_metrics, models.CORRELATION_MART),
}
_FACT = "fct_covid_daily"


def _dq_report_sql() -> str:
    tested = "tested AS (SELECT *, now() AS _fact_created_at FROM fact)"
    tests = {name: [ColumnTest(*t) for t in listed] for name, listed in expected.TESTS.items()}
    fact_rows = _report_sql(_FACT, tests[_FACT], "tested")
    parts = [on_fact(f"SELECT * FROM ({fact_rows})", tested)]
    for name, (_, sql) in _TESTED.items():
        parts.append(f"WITH built AS ({sql}) SELECT * FROM ({_report_sql(name, tests[name], 'built')})")
    return _with_passed(" UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts))


def _built(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A published table as written, since every test reads it again."""
    if name == _FACT:
        return trade.built_fact(spark, sf)
    return trade.build_once(name, spark, sf, lambda spark, sf: _TESTED[name][0](trade.built_fact(spark, sf)), tests=MODEL_TESTS[name])


@query("dq_report", _dq_report_sql())
def _dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that fail were counted while the tables were written; only what those counts leave open reads them again."""
    with ThreadPoolExecutor(AT_ONCE) as pool:  # none of them needs another but the fact
        _built(spark, sf, _FACT)
        built = dict(zip(MODEL_TESTS, pool.map(lambda name: _built(spark, sf, name), MODEL_TESTS), strict=True))
    known = {name: trade.failed_when_built("fact" if name == _FACT else name, spark, sf) for name in MODEL_TESTS}
    return run_tests(built, MODEL_TESTS, known)


def _layers_sql() -> str:
    """For every column of every built table: rows, and a sum over the digests of its cells."""
    built = {"fct_covid_daily": on_fact("SELECT * FROM fact")} | {name: sql for name, (_, sql) in _TESTED.items()}
    cell = """CASE WHEN COLUMNS('^[^_]') IS NULL THEN 0 ELSE CAST('0x' || substr(md5(
      CASE WHEN typeof(COLUMNS('^[^_]')) IN ('DOUBLE', 'FLOAT')
        THEN CAST(TRY_CAST(COLUMNS('^[^_]') AS DECIMAL(38,6)) AS VARCHAR)
        ELSE CAST(COLUMNS('^[^_]') AS VARCHAR) END), 1, 8) AS BIGINT) END"""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS model, TRUE AS after_inputs, "column", n, CAST(content AS BIGINT) AS content FROM (
          UNPIVOT (SELECT COUNT(*) AS _n, SUM({cell}) FROM ({sql})) ON COLUMNS('^[^_]') INTO NAME "column" VALUE content
        ) AS t(n, "column", content)""" for name, sql in built.items())


def _cell_digest(name: str, kind: str) -> Column:
    text = F.col(name).cast("decimal(38,6)").cast("string") if kind in ("double", "float") else F.col(name).cast("string")
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(0))


@query("build_layers", _layers_sql())
def _build_layers(spark: SparkSession, sf: str) -> DataFrame:
    """The gold tables built from the cleaned ones in dependency order, as a tagged run writes them, and what they hold."""
    warehouse = Warehouse(spark, f"{stage_folder(spark)}/warehouse-{uuid.uuid4().hex}")
    for name, rows in zip((SILVER_US, SILVER_GLOBAL), trade.cleaned_reports(spark, sf), strict=True):
        warehouse.write("silver", name, rows)
    done = run_models(warehouse, tags=["gold"])
    in_order = {m.name: all(i not in done or done.index(i) < done.index(m.name) for i in m.inputs) for m in select_models(["gold"])}
    parts = []
    for name in done:
        rows = warehouse.read("gold", name)
        kinds = {c: k for c, k in rows.dtypes if not c.startswith("_")}
        sums = rows.agg(F.count("*").alias("n"), *[F.sum(_cell_digest(c, k)).alias(c) for c, k in kinds.items()])
        long = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).alias("content")) for c in kinds]))
        parts.append(sums.select(F.lit(name).alias("model"), F.lit(in_order[name]).alias("after_inputs"), "n", long))
    return reduce(DataFrame.unionByName, parts)
