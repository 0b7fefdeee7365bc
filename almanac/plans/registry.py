"""Which tables exist, what they read, and building or testing the ones a tag selection names."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.quality import run_tests
from almanac.operators.union import union_drifting
from almanac.plans import agg, fact, mart, report, silver
from almanac.plans.column_tests import MODEL_TESTS
from almanac.sources.bronze import Bronze
from almanac.sources.buckets import buckets_by
from almanac.sources.feeds import SOURCE
from almanac.sources.files import path_of
from almanac.sources.warehouse import AT_ONCE, Warehouse


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    tags: frozenset[str]
    inputs: tuple[str, ...]  # other models, or feed:<name>
    build: Callable[..., DataFrame]
    partition_by: tuple[str, ...] = ()
    sort_by: str | None = None
    bucket_by: tuple[str, ...] = ()


def _gold(name: str, tag: str, build: Callable[..., DataFrame], *inputs: str, **kwargs) -> Model:
    return Model(name, "gold", frozenset({"gold", tag}), inputs or (FACT,), build, **kwargs)


# Names and tags under which users know the published tables.
FACT = "fct_covid_daily"
SILVER_GLOBAL, SILVER_US = "silver_covid_cases_global", "silver_covid_cases_us"
MODELS = {
    model.name: model
    for model in [
        Model(SILVER_GLOBAL, "silver", frozenset({"silver"}), ("feed:global",), silver.silver_global, bucket_by=fact.PLACE),
        Model(SILVER_US, "silver", frozenset({"silver"}), ("feed:us",), silver.silver_us, bucket_by=fact.PLACE),
        _gold(FACT, "fact", fact.fact_daily, SILVER_US, SILVER_GLOBAL, partition_by=fact.FACT_FOLDERS, sort_by=fact.FACT_SORT),
        _gold("agg_daily_summary", "agg", agg.daily_summary),
        _gold("agg_state_summary", "agg", agg.state_summary),
        _gold("agg_country_summary", "agg", agg.country_summary),
        _gold("mart_top_countries", "mart", mart.top_countries),
        _gold("mart_covid_trends", "mart", mart.trends),
        _gold("mart_correlation_metrics", "mart", mart.correlation_metrics),
        _gold("rpt_top_countries_by_cases", "report", report.top_countries_by_cases),
        _gold("rpt_covid_trends_over_time", "report", report.trends_over_time),
        _gold("rpt_correlation_analysis", "report", report.correlation_analysis),
    ]
}


def select_models(tags: Iterable[str] = (), names: Iterable[str] = ()) -> list[Model]:
    """Models that carry all the tags (and are among `names`, when given), inputs before users."""
    wanted, listed = set(tags), set(names)
    unknown = listed - MODELS.keys()
    if unknown:
        raise ValueError(f"no such models: {sorted(unknown)}")
    chosen = {n for n, m in MODELS.items() if wanted <= m.tags and (not listed or n in listed)}
    edges = {n: [i for i in m.inputs if i in MODELS] for n, m in MODELS.items()}
    return [MODELS[n] for n in TopologicalSorter(edges).static_order() if n in chosen]


def run_models(warehouse: Warehouse, tags: Iterable[str] = (), names: Iterable[str] = (), at_once: int = AT_ONCE) -> list[str]:
    """Build and write the selected tables, each once its inputs are written; independent ones at the same time.

    The first failure stops the run when the builds under way have ended. A model reads its inputs as written
    tables, so lineage ends at each layer. Rows that fail a declared test are counted as they are written.
    """
    chosen = {model.name: model for model in select_models(tags, names)}
    order = TopologicalSorter({n: [i for i in m.inputs if i in chosen] for n, m in chosen.items()})
    order.prepare()
    built: list[str] = []
    with ThreadPoolExecutor(at_once) as pool:
        running: dict[Future, str] = {}
        while order.is_active():
            running |= {pool.submit(_build, warehouse, chosen[name]): name for name in order.get_ready()}
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for name in sorted(running.pop(future) for future in done if future.exception() is None):
                built.append(name)
                order.done(name)
            for future in done:
                future.result()
    return built


def _build(warehouse: Warehouse, model: Model) -> None:
    rows = model.build(*[_input(warehouse, name) for name in model.inputs])
    buckets = buckets_by(warehouse.spark, *model.bucket_by) if model.bucket_by else None
    warehouse.write(model.layer, model.name, rows, model.partition_by, model.sort_by, MODEL_TESTS.get(model.name, ()), buckets)


def test_models(warehouse: Warehouse, tags: Iterable[str] = (), names: Iterable[str] = ()) -> DataFrame:
    """Results of the declared column tests of the selected tables, one row per test."""
    chosen = [model for model in select_models(tags, names) if model.name in MODEL_TESTS]
    if not chosen:
        raise ValueError("no declared tests in the selection")
    tables = {model.name: warehouse.read(model.layer, model.name) for model in chosen}
    return run_tests(tables, MODEL_TESTS, {model.name: warehouse.failed(model.layer, model.name) for model in chosen})


test_models.__test__ = False  # not a test case


def _input(warehouse: Warehouse, name: str) -> DataFrame:
    if name.startswith("feed:"):
        return feed_rows(warehouse, name.removeprefix("feed:"))
    return warehouse.read(MODELS[name].layer, name)


def feed_rows(warehouse: Warehouse, feed: str) -> DataFrame:
    """Bronze rows of a feed: the ingested dataset and any bronze table named <feed>_..."""
    inputs = _tables_by_schema(warehouse, f"{feed}_")
    ingested = Bronze(warehouse.spark, f"{warehouse.root}/bronze", feed)
    if ingested.loaded():
        inputs[feed] = ingested.read()
    if not inputs:
        raise FileNotFoundError(f"feed {feed!r} has no bronze rows under {warehouse.root}")
    return union_drifting(inputs, SOURCE)


def _tables_by_schema(warehouse: Warehouse, prefix: str) -> dict[str, DataFrame]:
    """One scan per distinct schema, not per table; the table's name comes from the file path."""
    table = F.regexp_extract(path_of(F.col("_metadata.file_path")), r"/bronze/([^/]+)/", 1)
    return {
        paths[0]: warehouse.spark.read.schema(schema).parquet(*paths).withColumn(SOURCE, F.concat(F.lit("bronze."), table))
        for schema, paths in warehouse.by_schema("bronze", prefix)
    }
