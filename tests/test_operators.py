import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.operators.context import with_group_totals
from almanac.operators.correlate import Pair, pair_statistics
from almanac.operators.latest import latest_overall, latest_per_key, rows_of_top_keys
from almanac.operators.quality import accepted, not_null, run_tests, unique
from almanac.operators.ranking import Percentile, Rank, top_rows, with_ranks, with_share
from almanac.operators.series import SeriesMetrics, with_series
from almanac.operators.union import common_type, union_drifting

METRICS = SeriesMetrics(previous={"prev": "n"}, trailing_mean={"mean": "n"})
DAY = dt.date(2020, 1, 1)


def brute_series(rows):
    """(place, day, source, n) -> {(place, day, source, n): (prev, mean)} in plain Python."""
    last = dt.date.max
    places = {}
    for r in rows:
        places.setdefault(r[0], []).append(r)
    found = []
    for group in places.values():
        group.sort(key=lambda r: (r[1] or last, r[2], r[3]))
        for i, r in enumerate(group):
            near = [x[3] for x in group[max(0, i - 6): i + 1]]
            found.append((*r, group[i - 1][3] if i else None, round(sum(near) / len(near), 6)))
    return sorted(found, key=str)


def collected(df):
    rows = [(r.place, r.day, r.source, r.n, r.prev, round(r["mean"], 6)) for r in df.collect()]
    return sorted(rows, key=str)


def series_rows():
    rng = random.Random(5)
    rows = []
    for place, count in [("hot", 300), ("warm", 40), (None, 9), ("single", 1)]:
        for i in range(count):
            day = None if i % 50 == 49 else DAY + dt.timedelta(days=rng.randrange(12))
            rows.append((place, day, f"file_{rng.randrange(3)}", i))
    return rows


def test_series_counts_rows_not_days(spark):
    rows = [("a", DAY, "f", 10), ("a", DAY + dt.timedelta(days=1), "f", 12), ("a", DAY + dt.timedelta(days=3), "f", 9)]
    df = spark.createDataFrame(rows, "place string, day date, source string, n bigint")
    got = with_series(df, ["place"], ["day"], METRICS, one_row_per_day=True).orderBy("day").collect()
    assert [(r.prev, round(r["mean"], 4)) for r in got] == [(None, 10.0), (10, 11.0), (12, 10.3333)]


@pytest.mark.parametrize("block_rows", [4, 16, 1000])
def test_hot_location_split_over_tasks_gives_the_same_rows(spark, block_rows):
    rows = series_rows()
    # n rises with the input order, so that equal (day, source) rows are ordered by n in both
    df = spark.createDataFrame(rows, "place string, day date, source string, n bigint").coalesce(1)
    got = with_series(df, ["place"], ["day", "source"], METRICS, hot_rows=30, block_rows=block_rows)
    assert collected(got.filter(F.col("place").isin("hot", "warm"))) == brute_series(
        [r for r in rows if r[0] in ("hot", "warm")]
    )
    assert got.count() == len(rows)


def test_hot_location_of_equal_rows(spark):
    df = spark.createDataFrame([("a", DAY, "f", 5)] * 100, "place string, day date, source string, n bigint")
    got = with_series(df, ["place"], ["day", "source"], METRICS, hot_rows=10, block_rows=8).collect()
    assert len(got) == 100
    assert sum(r.prev is None for r in got) == 1 and {r["mean"] for r in got} == {5.0}


def rank_rows(spark):
    rng = random.Random(3)
    rows = [(f"k{i:03d}", None if i % 17 == 0 else rng.randrange(12), rng.randrange(1000)) for i in range(200)]
    return spark.createDataFrame(rows, "key string, a bigint, b bigint")


def test_ranks_over_ranges_equal_ranks_in_one_task(spark):
    groups = rank_rows(spark)
    ranks = [Rank("by_a", "a"), Rank("by_b", "b")]
    shares = [Percentile("p_a", "a"), Percentile("p_b", "b")]
    one = with_ranks(groups, "key", ranks, shares)
    many = with_ranks(groups, "key", ranks, shares, one_task_rows=15)
    columns = ["key", "by_a", "by_b", "p_a", "p_b"]
    left = one.select(columns).orderBy("key").collect()
    assert left == many.select(columns).orderBy("key").collect()
    assert sorted(r.by_a for r in left) == list(range(1, 201))


def test_absent_values_rank_first(spark):
    groups = spark.createDataFrame([("x", 5), ("y", None), ("z", 9)], "key string, a bigint")
    got = {r.key: r.r for r in with_ranks(groups, "key", [Rank("r", "a")]).collect()}
    assert got == {"y": 1, "z": 2, "x": 3}


def test_percentile_of_a_single_group(spark):
    groups = spark.createDataFrame([("x", 5)], "key string, a bigint")
    assert with_ranks(groups, "key", [], [Percentile("p", "a")]).collect()[0].p == 0.0


def test_top_rows_keep_the_share_of_all(spark):
    groups = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20), ("d", 30)], "key string, v bigint")
    best = with_share(top_rows(groups, "v", "key", 3, "r"), "v", "share", groups)
    assert [(r.key, r.r, r.share) for r in best.orderBy("r").collect()] == [
        ("a", 1, 38.46), ("b", 2, 23.08), ("d", 3, 23.08),
    ]


def test_latest(spark):
    d2 = DAY + dt.timedelta(days=1)
    rows = [("a", DAY, 1), ("a", d2, 2), ("a", d2, 3), ("b", DAY, 4), ("b", None, 5), (None, d2, 6)]
    df = spark.createDataFrame(rows, "k string, day date, n int")
    assert sorted(r.n for r in latest_per_key(df, "k", "day").collect()) == [2, 3, 4]
    assert sorted(r.n for r in latest_overall(df, "day").collect()) == [2, 3, 6]
    assert sorted(r.n for r in rows_of_top_keys(df, "k", "n", 2).collect()) == [4, 5]


def test_group_totals_with_absent_keys(spark):
    rows = [("a", 1, 10), ("a", 1, 20), ("a", None, 5), ("a", None, 7), (None, 1, 1)]
    df = spark.createDataFrame(rows, "k string, w int, n int")
    got = with_group_totals(df, ["k", "w"], {"total": F.sum("n")}).collect()
    assert sorted((r.n, r.total) for r in got) == [(1, 1), (5, 12), (7, 12), (10, 30), (20, 30)]


PAIRS = [Pair("xy", "x", "y", ("y",)), Pair("xc", "x", "c", ("c",)), Pair("xn", "x", "n", ("n",))]


def test_correlation_edges(spark):
    rows = [(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, None, 5.0, None), (4.0, 8.0, 5.0, None)]
    df = spark.createDataFrame(rows, "x double, y double, c double, n double")
    got = {r.metric_pair: r for r in pair_statistics(df, PAIRS).collect()}
    assert round(got["xy"].correlation_coefficient, 12) == 1.0 and got["xy"].sample_size == 3
    assert got["xc"].correlation_coefficient is None and got["xc"].metric_2_stddev == 0.0
    assert got["xn"].correlation_coefficient is None and got["xn"].metric_1_stddev is None
    empty = pair_statistics(df.filter("x > 100"), PAIRS).collect()
    assert [(r.metric_pair, r.sample_size, r.correlation_coefficient) for r in empty] == [
        ("xy", 0, None), ("xc", 0, None), ("xn", 0, None),
    ]


def test_correlation_reads_its_input_once(spark, tmp_path):
    spark.range(10).selectExpr("id * 1.0d x", "id * 2.0d y", "5d c", "1d n").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = pair_statistics(df, PAIRS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_common_type():
    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert common_type([i, l]) == l
    assert common_type([l, d]) == d
    assert common_type([l, T.NullType()]) == l
    assert common_type([T.DateType(), T.TimestampType()]) == T.TimestampType()
    assert common_type([l, s]) == s
    assert common_type([T.BooleanType(), l]) == s


def test_union_of_drifting_tables(spark):
    a = spark.createDataFrame([(1, "x")], "`Key` bigint, `Name/Full` string")
    b = spark.createDataFrame([(2.5, 7)], "key double, extra int")
    c = spark.createDataFrame([("t",)], "extra string")
    got = union_drifting({"a": a, "b": b, "c": c})
    assert got.columns == ["key", "name_full", "extra", "_source"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1.0, "x", None, "a"), (2.5, None, "7", "b"), (None, None, "t", "c")], key=str
    )
    with pytest.raises(ValueError):
        union_drifting({})


def test_column_tests(spark):
    rows = [(1, "a"), (1, "b"), (2, "b"), (2, None), (3, "z"), (None, "z"), (None, "y")]
    df = spark.createDataFrame(rows, "id int, tag string")
    tests = [not_null("id"), unique("id"), not_null("tag"), accepted("tag", "a", "b"), accepted("id", 1, 2, 3)]
    got = [(r.model, r.column, r.test, r.failures, r.passed) for r in run_tests({"m": df}, {"m": tests}).collect()]
    assert sorted(got) == sorted([
        ("m", "id", "not_null", 2, False),
        ("m", "id", "unique", 2, False),
        ("m", "tag", "not_null", 1, False),
        ("m", "tag", "accepted_values", 2, False),  # z and y
        ("m", "id", "accepted_values", 0, True),
    ])


def test_column_tests_of_all_types(spark):
    from collections import Counter
    from decimal import Decimal

    columns = {
        "a string": ["x", "x", "X", "", None, "é"], "b double": [0.5, 0.5, float("nan"), float("nan"), None, 2.0], "c date": [dt.date(2020, 1, 1)] * 2 + [None] * 4,
        "d timestamp": [dt.datetime(2020, 1, 1, 0, 0, 0, i % 2) for i in range(6)], "e decimal(30,2)": [Decimal(i // 4) for i in range(6)],
        "f binary": [b"1", b"1", b"2", None, b"", b""], "g boolean": [True, False, None, None, None, None], "h bigint": [2**62, -(2**62), 0, 0, 0, 1],
    }
    df = spark.createDataFrame([*zip(*columns.values())], ", ".join(columns))
    tests = [unique(c) for c in df.columns] + [accepted("a", "x"), accepted("h", 0), accepted("f", bytearray(b"1"))]
    got = {(r.column, r.test): r.failures for r in run_tests({"m": df}, {"m": tests}).collect()}
    for name, values in zip(df.columns, columns.values()):
        assert got[name, "unique"] == sum(n > 1 for v, n in Counter(map(str, values)).items() if v != "None"), name
    assert (got["a", "accepted_values"], got["h", "accepted_values"], got["f", "accepted_values"]) == (3, 3, 2)


def test_texts_with_one_hash_are_told_apart(spark, monkeypatch):
    from almanac.operators import quality

    monkeypatch.setattr(quality.F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "tag string")
    tests = [unique("tag"), accepted("tag", "a"), not_null("tag")]
    assert {r.test: r.failures for r in run_tests({"m": df}, {"m": tests}).collect()} == {"unique": 1, "accepted_values": 2, "not_null": 1}


def test_texts_are_read_again_only_where_hashes_repeat(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("key")).write.parquet(str(tmp_path / "t"))
    rows = run_tests({"m": spark.read.parquet(str(tmp_path / "t"))}, {"m": [unique("key")]})
    assert [r.passed for r in rows.collect()] == [True]
    final = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "FileScan" not in final  # the join with no hashes is gone, and its scan with it
