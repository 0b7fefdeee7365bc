import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from almanac.functions import clean, labels
from almanac.functions import metrics as m


def values(spark, column, rows, schema):
    """The expression over rows of (id, ...), in id order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id int, {schema}")
    return [row.v for row in df.select("id", column.alias("v")).orderBy("id").collect()]


def one(spark, column, cells, dtype):
    return values(spark, column, [(c,) for c in cells], f"x {dtype}")


def test_clean_text(spark):
    assert one(spark, clean.clean_text(F.col("x")), [" a ", "", "   ", None, "\t"], "string") == ["a", None, None, None, "\t"]
    assert one(spark, clean.clean_text_or(F.col("x"), "Unknown"), [" ", None, "US"], "string") == ["Unknown", "Unknown", "US"]


def test_placeholders_and_guards(spark):
    assert one(spark, clean.zero_to_null(F.col("x")), [0.0, -1.5, None], "double") == [None, -1.5, None]
    assert one(spark, clean.null_to_zero(F.col("x")), [None, -3, 4], "bigint") == [0, -3, 4]
    assert one(spark, clean.not_below_zero(F.col("x")), [-0.1, 0.0, 2.0, None], "double") == [None, 0.0, 2.0, None]
    cells = [-1.0, 0.0, 100.0, 100.1, None]
    assert one(spark, clean.within_percent(F.col("x")), cells, "double") == [None, 0.0, 100.0, None, None]


def test_text_to_numbers(spark):
    cells = ["7", "7.0", " 8 ", "-2", "x", "", None, "2.5"]
    assert one(spark, clean.to_count(F.col("x")), cells, "string") == [7, 7, 8, -2, None, None, None, 3]
    assert one(spark, clean.is_whole(F.col("x")), cells, "string") == [True, True, True, True, False, False, False, False]
    assert one(spark, clean.to_rate(F.col("x")), ["1.25", "nan", "x", None], "string") == [1.25, None, None, None]
    assert one(spark, clean.na_to_null(F.col("x")), ["NA", "nan", "", "Nan", None], "string") == [None, None, None, "Nan", None]


def test_update_times(spark):
    cells = ["1/22/2020 17:00", "2/1/20 1:52", "2020-02-02T23:43:02", "2020-03-22 08:18:20", " ", "soon", None,
             "3/8/20 5:31:07", "13/45/2020 1:00", "1/22/2020"]
    at = dt.datetime
    assert one(spark, clean.to_utc_timestamp(F.col("x")), cells, "string") == [
        at(2020, 1, 22, 17, 0), at(2020, 2, 1, 1, 52), at(2020, 2, 2, 23, 43, 2), at(2020, 3, 22, 8, 18, 20),
        None, None, None, at(2020, 3, 8, 5, 31, 7), None, at(2020, 1, 22),
    ]
    assert one(spark, clean.to_day(F.col("x")), ["2020-04-12", "4/12/2020", "4/12/20 3:00", "4/12/20", "x"], "string") == [
        *[dt.date(2020, 4, 12)] * 4, None,
    ]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo", "UTC"])
def test_times_are_utc_whatever_the_session_zone(spark, zone):
    cells = ["1/22/2020 17:00", "2020-03-22 08:18:20", "2020-02-02T23:43:02", "2020-03-22", "3/8/20", "2020-03-22 08:18:20-05:00", "2020-03-22 08:18:20Z"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(c,) for c in cells], "x string")
        parsed = clean.to_utc_timestamp(F.col("x"))
        got = [tuple(r) for r in rows.select(F.unix_seconds(parsed), clean.to_day(F.col("x")), clean.utc_day(parsed)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    at = lambda *parts: int(dt.datetime(*parts, tzinfo=dt.timezone.utc).timestamp())
    assert [g[0] for g in got] == [
        at(2020, 1, 22, 17), at(2020, 3, 22, 8, 18, 20), at(2020, 2, 2, 23, 43, 2), at(2020, 3, 22), at(2020, 3, 8),
        at(2020, 3, 22, 13, 18, 20), at(2020, 3, 22, 8, 18, 20),
    ]
    days = [dt.date(2020, 1, 22), dt.date(2020, 3, 22), dt.date(2020, 2, 2), dt.date(2020, 3, 22), dt.date(2020, 3, 8)]
    assert [g[2] for g in got[:5]] == days and [g[1] for g in got[:5]] == days


def test_names():
    assert clean.normalize_names([" Province/State ", "Last Update", "Case-Fatality_Ratio"]) == [
        "province_state", "last_update", "case-fatality_ratio",
    ]
    with pytest.raises(ValueError, match="repeat"):
        clean.normalize_names(["Lat", "lat"])


def test_lineage_name(spark):
    cells = ['"warehouse"."bronze"."us_04_12_2020"', "bronze.us_04_12_2020", '""a""']
    assert one(spark, clean.lineage_name(F.col("x")), cells, "string") == [
        "bronze.us_04_12_2020", "bronze.us_04_12_2020", "a",
    ]


def test_rounding_takes_the_written_decimal(spark):
    assert one(spark, m.round_half_up(F.col("x"), 2), [1.005, -1.005, 2.675, float("nan"), None], "double") == [
        1.01, -1.01, 2.68, None, None,
    ]


def test_percentages(spark):
    rows = [(1, 3), (1, 0), (1, -2), (None, 3), (1, None), (1, 800)]
    assert values(spark, m.safe_pct(F.col("a"), F.col("b")), rows, "a bigint, b bigint") == [
        33.33, None, None, None, None, 0.13,
    ]
    rows = [(12, 10), (8, 10), (5, 0), (5, None)]
    assert values(spark, m.pct_change(F.col("a"), F.col("b")), rows, "a bigint, b bigint") == [20.0, -20.0, None, None]
    assert values(spark, m.delta(F.col("a"), F.col("b")), rows, "a bigint, b bigint") == [2, -2, 5, 0]


def test_percentages_of_large_counts_are_exact(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(10**k), rng.randrange(1, 10**k)) for k in (3, 6, 9, 12) for _ in range(500)]
    # next to and on the middle between two results
    for d in (8, 800, 20_000, 2 * 10**8, 2 * 10**11):
        rows += [(d * odd // 20_000 + step, d) for odd in (1, 3, 15, 2001) for step in (-1, 0, 1)]
    rows = [(n, d) for n, d in rows if n >= 0]
    exact = [float((Decimal(100 * n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for n, d in rows]
    assert values(spark, m.safe_pct(F.col("a"), F.col("b")), rows, "a bigint, b bigint") == exact


def test_surrogate_key(spark):
    import hashlib

    key = m.surrogate_key(F.col("a"), F.coalesce("b", F.lit("")), F.col("d"))
    rows = [("US", None, dt.date(2020, 1, 2)), ("US", "x", None)]
    texts = ["US--2020-01-02", "US-x-_dbt_utils_surrogate_key_null_"]
    assert values(spark, key, rows, "a string, b string, d date") == [
        hashlib.md5(t.encode()).hexdigest() for t in texts
    ]


def test_location_name(spark):
    rows = [("Texas", "US"), (None, "Peru"), ("Texas", None)]
    assert values(spark, m.location_name(F.col("p"), F.col("c")), rows, "p string, c string") == [
        "Texas, US", "Peru", None,
    ]


def test_date_parts_mix_calendar_year_and_iso_week(spark):
    days = [dt.date(2022, 1, 1), dt.date(2022, 12, 31), dt.date(2020, 5, 6)]
    parts = m.date_parts(F.col("x"))
    assert one(spark, parts["week_of_year"], days, "date") == [52, 52, 19]
    assert one(spark, parts["report_year"], days, "date") == [2022, 2022, 2020]
    assert one(spark, parts["day_of_week"], days, "date") == ["Saturday ", "Saturday ", "Wednesday"]


def test_severity_edges(spark):
    cells = [999, 1000, 9999, 10_000, 99_999, 100_000, 499_999, 500_000, 999_999, 1_000_000, None]
    assert one(spark, labels.SEVERITY(F.col("x")), cells, "bigint") == [
        "Very Low", "Low", "Low", "Moderate", "Moderate", "High", "High", "Very High", "Very High", "Critical",
        "Very Low",
    ]


def test_rank_ladders(spark):
    cells = [1, 3, 5, 6, 10, 11, 20, 21, 25, 30, 31, 50, 51]
    state = dict(zip(cells, one(spark, labels.STATE_IMPACT(F.col("x")), cells, "bigint")))
    assert [state[c] for c in (5, 6, 10, 11, 20, 21, 30, 31)] == [
        "Top 5 - Critical", "Top 10 - Severe", "Top 10 - Severe", "Top 20 - High", "Top 20 - High", "Moderate",
        "Moderate", "Lower Impact",
    ]
    tier = dict(zip(cells, one(spark, labels.GLOBAL_TIER(F.col("x")), cells, "bigint")))
    assert [tier[c] for c in (10, 11, 25, 30, 50, 51)] == [
        "Top 10 Globally", "Top 25 Globally", "Top 25 Globally", "Top 50 Globally", "Top 50 Globally", "Other",
    ]
    top = dict(zip(cells, one(spark, labels.TOP_TIER(F.col("x")), cells, "bigint")))
    assert [top[c] for c in (1, 3, 5, 6)] == ["Highest", "Very High", "High", "Other"]


def test_rate_and_change_ladders(spark):
    assert one(spark, labels.FATALITY_CLASS(F.col("x")), [5.0, 4.9, 3.0, 2.0, 1.0, 0.9, None], "double") == [
        "Very High Severity", "High Severity", "High Severity", "Moderate Severity", "Low Severity",
        "Very Low Severity", "Very Low Severity",
    ]
    assert one(spark, labels.TREND_STRENGTH(F.abs(F.col("x"))), [-20.0, 19.9, 10.0, -5.0, 4.9, None], "double") == [
        "Sharp", "Moderate", "Moderate", "Gradual", "Minimal", "Minimal",
    ]


def test_trends(spark):
    rows = [(2, 1), (1, 2), (1, 1), (1, None), (None, 1)]
    schema = "a bigint, b bigint"
    assert values(spark, labels.case_trend(F.col("a"), F.col("b")), rows, schema) == [
        "Increasing", "Decreasing", "Stable", "Unknown", "Unknown",
    ]
    assert values(spark, labels.total_trend(F.col("a"), F.col("b")), rows, schema) == [
        "Rising", "Falling", "Stable", "Stable", "Stable",
    ]


def test_correlation_labels(spark):
    cells = [0.9, -0.9, 0.7, 0.5, 0.3, 0.29, None]
    assert one(spark, labels.CORRELATION_STRENGTH(F.abs(F.col("x"))), cells, "double") == [
        "Very Strong", "Very Strong", "Strong", "Moderate", "Weak", "Very Weak or None", "Very Weak or None",
    ]
    assert one(spark, labels.correlation_direction(F.col("x")), [0.1, -0.1, 0.0, None], "double") == [
        "Positive", "Negative", "None", "None",
    ]
    sizes = [29, 30, 99, 100, 999, 1000]
    assert one(spark, labels.CONFIDENCE(F.col("x")), sizes, "bigint") == [
        "Low confidence", *["Medium confidence"] * 2, *["High confidence"] * 3,
    ]
    assert one(spark, labels.CONFIDENCE_MART(F.col("x")), sizes, "bigint")[-2:] == ["High confidence", "Very High confidence"]


def test_explanations(spark):
    pairs = [labels.CASES_DEATHS, labels.NEW_CASES_POSITIVITY, "other"]
    report = one(spark, labels.explanation(F.col("x"), labels.REPORT_EXPLANATIONS), pairs, "string")
    assert report[0].startswith("Strong positive") and report[1:] == [labels.NO_EXPLANATION] * 2
    assert one(spark, labels.explanation(F.col("x"), labels.MART_EXPLANATIONS), pairs, "string")[1] != labels.NO_EXPLANATION
