import datetime as dt
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from almanac.plans.silver import silver_us
from almanac.sources import reports
from almanac.sources.reports import (
    ingest_reports, list_reports, read_bronze, read_faults, read_headers, usable_columns,
)
from almanac.sources.seeds import read_seeds, seed_table_name
from almanac.streaming.reports import ingest_new_reports
from report_files import FAULTS, GLOBAL_FILES, us_files, us_row, write_landing, US_HEADER


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return write_landing(tmp_path_factory.mktemp("landing"))


@pytest.fixture(scope="module")
def bronze(spark, landing, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    faults = {feed: ingest_reports(spark, str(landing), feed, root).collect() for feed in ("global", "us")}
    return root, faults


def described(faults):
    return {(r.file, r.left_out, r.reason, r.column) for r in faults}


def test_faults_are_left_out_and_kept(spark, bronze):
    root, faults = bronze
    assert faults["global"] == []
    assert described(faults["us"]) == FAULTS
    kept = read_faults(spark, root, "us").collect()
    assert described(kept) == FAULTS and len({r.load for r in kept}) == 1
    wrong = next(r for r in kept if r.column == "confirmed")
    assert wrong.cell == "many" and "Ohio" in wrong.line
    loaded = {r.file_date for r in read_bronze(spark, root, "us").select("file_date").distinct().collect()}
    assert loaded == {dt.datetime.strptime(n, "%m-%d-%Y.csv").date() for n in us_files()}


def test_columns_do_not_shift_between_headers(spark, bronze):
    rows = read_bronze(spark, bronze[0], "global")
    china = rows.filter("country_region = 'China'").orderBy("file_date").collect()
    assert [(r.province_state, r.confirmed, r.deaths, r.recovered, r.lat, r["_source"]) for r in china] == [
        ("Hubei", "444", "17", "28", None, "bronze.global_01_22_2020"),
        ("Hubei", "7153", "249", "168", None, "bronze.global_02_01_2020"),
        ("Hubei, Wuhan", "68135", "4512", None, None, "bronze.global_06_03_2020"),
    ]
    italy = rows.filter("country_region = 'Italy'").collect()[0]
    assert (italy.lat, italy.confirmed, italy.combined_key) == ("41.87", "59138", "Italy")
    assert rows.count() == sum(len([x for x in t.splitlines() if x.strip()]) - 1 for t in GLOBAL_FILES.values())


def test_columns_outside_the_feed_are_kept(spark, bronze):
    rows = read_bronze(spark, bronze[0], "global", ["country_region", "case-fatality_ratio"])
    assert [r[1] for r in rows.filter("file_date = '2020-06-01'").collect()] == ["14.2"]


def test_other_spellings_can_be_mapped(spark, landing, tmp_path):
    root = str(tmp_path / "bronze")
    ingest_reports(spark, str(landing), "global", root, {"case-fatality_ratio": "case_fatality_ratio"})
    rows = read_bronze(spark, root, "global").filter("file_date = '2020-06-01'")
    assert [r.case_fatality_ratio for r in rows.collect()] == ["14.2"]


def test_reload_replaces_only_the_files_it_reads(spark, landing, tmp_path):
    mine = shutil.copytree(landing, tmp_path / "landing")
    root = str(tmp_path / "bronze")
    ingest_reports(spark, str(mine), "us", root)
    before = read_bronze(spark, root, "us").groupBy("file_date").agg(F.sum("confirmed").alias("n")).collect()

    ingest_reports(spark, str(mine), "us", root)
    again = read_bronze(spark, root, "us").groupBy("file_date").agg(F.sum("confirmed").alias("n")).collect()
    assert sorted(again) == sorted(before)

    day = dt.date(2020, 4, 13)
    (mine / "us" / "04-13-2020.csv").write_text(US_HEADER + "\n" + us_row("Texas", day, 1))
    # a reload that cannot be read leaves the earlier version of that day
    (mine / "us" / "04-12-2020.csv").write_text("a,b\n1,2\n")
    # files with a header and no rows, or with no row that can be used, replace it
    (mine / "us" / "04-15-2020.csv").write_text(US_HEADER + "\n")
    (mine / "us" / "05-01-2020.csv").write_text(US_HEADER + "\n" + us_row("Texas", dt.date(2020, 5, 1), "x"))
    ingest_reports(spark, str(mine), "us", root)
    after = read_bronze(spark, root, "us").groupBy("file_date").agg(F.sum("confirmed").alias("n")).collect()
    expected = {r.file_date: r.n for r in before} | {day: 1.0}
    del expected[dt.date(2020, 4, 15)], expected[dt.date(2020, 5, 1)]
    assert {r.file_date: r.n for r in after} == expected


def test_rows_of_another_length(spark, tmp_path):
    folder = tmp_path / "landing" / "global"
    folder.mkdir(parents=True)
    head = "Province_State,Country_Region,Confirmed,Combined_Key\n"
    (folder / "01-01-2021.csv").write_text(head + "Lima,Peru\n" + '"a,b",Peru,3,"x, y"\n')  # a short row
    (folder / "01-02-2021.csv").write_text(head + 'Lima,Peru,4,"two\nlines"\n"Cus\nco",Peru,5,k\n,Chile,6,\n')
    (folder / "01-03-2021.csv").write_text(head + '"Lima,Peru,7,never closed\n,Chile,8,\n')
    (folder / "01-04-2021.csv").write_text(head + 'Lima,Peru,"two\nlines",k\n')  # joined, and then of the wrong type
    # names that Spark cannot take as they are
    (folder / "01-05-2021.csv").write_text("Country/Region,,Confirmed,Confirmed,a`b.c\nCuba,1,9,8,7\n")
    root = str(tmp_path / "bronze")
    faults = ingest_reports(spark, str(tmp_path / "landing"), "global", root).collect()
    assert sorted((r.file, r.left_out, r.reason) for r in faults) == [
        ("01-03-2021.csv", "file", "quote left open"), ("01-04-2021.csv", "row", "cell of the wrong type"),
    ]
    rows = read_bronze(spark, root, "global").select("province_state", "country_region", "confirmed", "combined_key")
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([
        ("Lima", "Peru", None, None), ("a,b", "Peru", "3", "x, y"), ("Lima", "Peru", "4", "two\nlines"),
        ("Cus\nco", "Peru", "5", "k"), (None, "Chile", "6", None), (None, "Cuba", "9", None),
    ], key=str)
    odd = read_bronze(spark, root, "global", ["unnamed:_1", "confirmed.1", "a`b.c"]).filter("file_date = '2021-01-05'")
    assert [tuple(r)[:3] for r in odd.collect()] == [("1", "8", "7")]


def test_one_odd_cell_costs_no_other_row(spark, tmp_path):
    folder = tmp_path / "landing" / "us"
    folder.mkdir(parents=True)
    day = dt.date(2020, 4, 12)
    rows = [us_row(f"S{i}", day, i) for i in range(1000)]
    odd = us_row("Odd", day, 5).replace(f"{day:%Y-%m-%d} 04:30:00", "yesterday")
    half = us_row("Half", day, "7.5")
    (folder / "04-12-2020.csv").write_text(US_HEADER + "\n" + "".join([*rows, odd, half]))
    root = str(tmp_path / "bronze")
    faults = ingest_reports(spark, str(tmp_path / "landing"), "us", root).collect()
    assert sorted((r.left_out, r.column, r.cell) for r in faults) == [("cell", "last_update", "yesterday"), ("row", "confirmed", "7.5")]
    loaded = read_bronze(spark, root, "us")
    assert loaded.count() == 1001
    cleaned = silver_us(loaded).where("province_state = 'Odd'").collect()
    assert [(r.confirmed_cases, r.last_updated_at) for r in cleaned] == [(5, None)]


def test_a_column_that_no_file_has_is_an_error(spark, tmp_path):
    folder = tmp_path / "landing" / "us"
    folder.mkdir(parents=True)
    day = dt.date(2020, 4, 12)
    (folder / "04-12-2020.csv").write_text(US_HEADER.replace("Confirmed", "Cases").replace("Deaths", "Dead") + "\n" + us_row("Ohio", day, 5))
    root = str(tmp_path / "bronze")
    assert ingest_reports(spark, str(tmp_path / "landing"), "us", root).count() == 0
    with pytest.raises(ValueError, match="'confirmed', 'deaths'"):
        silver_us(read_bronze(spark, root, "us"))
    ingest_reports(spark, str(tmp_path / "landing"), "us", root, {"cases": "confirmed", "dead": "deaths"})
    assert [r.confirmed_cases for r in silver_us(read_bronze(spark, root, "us")).collect()] == [5]


def test_one_scan_whatever_the_headers(spark, landing, tmp_path, monkeypatch):
    plans = []
    staged = reports.stage
    monkeypatch.setattr(reports, "stage", lambda df, name, *more: plans.append((name, df._jdf.queryExecution().toString())) or staged(df, name, *more))
    ingest_reports(spark, str(landing), "global", str(tmp_path / "bronze"))
    parsed = [plan for name, plan in plans if name == "rows"]
    assert len(parsed) == 1 and parsed[0].split("== Physical Plan ==")[-1].count("FileScan csv") == 1


def test_headers_by_text_scan_equal_fetched_headers(spark, landing):
    files = list_reports(spark, str(landing / "us")).unionByName(list_reports(spark, str(landing / "global")))
    files = files.where("length > 0")
    fetched = {r.path: r.header for r in read_headers(files).collect()}
    scanned = {r.path: r.header for r in reports._scan_headers(files).collect()}
    bad = next(p for p in fetched if p.endswith("bad.csv"))
    assert fetched.pop(bad) is None and scanned.pop(bad) is None
    assert fetched == scanned and len(fetched) == len(GLOBAL_FILES) + len(us_files()) + 3


def test_first_lines(tmp_path):
    first_line = reports._first_line_reader(4)
    contents = {b"Lat,Long_\r\n1,2\n": "Lat,Long_", b"Lat,Long_": "Lat,Long_", b"x" * 50: "x" * 50, b"\n1": None, b"\xff\n": None}
    for i, (data, line) in enumerate(contents.items()):
        path = tmp_path / f"a b+{i}.csv"
        path.write_bytes(data)
        assert first_line(f"file:{path}") == line
    assert first_line(f"file:{tmp_path}/none.csv") is None
    with pytest.raises(OSError):  # the task fails and is repeated; the file is not given up
        first_line(f"file:{tmp_path}")


def test_task_code_needs_no_package_on_the_executors():
    from pyspark import cloudpickle

    fetch = reports._header_fetcher(reports._first_line_reader(4))
    shipped = cloudpickle.dumps(fetch)
    probe = "import sys, pickle; pickle.load(sys.stdin.buffer); assert not any(m.startswith('almanac') for m in sys.modules)"
    subprocess.run([sys.executable, "-c", probe], input=shipped, check=True, cwd="/tmp", env={"PATH": "/usr/bin:/bin"})


def test_headers_that_cannot_be_used():
    for header, reason in [(None, "readable"), ("x,y", "known"), ("Lat,lat", "repeat")]:
        with pytest.raises(ValueError, match=reason):
            usable_columns(header, "us")
    assert usable_columns('"Country/Region", Lat ', "global") == ["country_region", "lat"]
    spellings = {"case-fatality_ratio": "case_fatality_ratio", "latitude": "lat"}
    assert usable_columns("Latitude,Case-Fatality_Ratio", "us", spellings) == ["lat", "case_fatality_ratio"]
    with pytest.raises(ValueError, match="repeat"):
        usable_columns("Latitude,Lat", "us", spellings)
    assert usable_columns("Lat,,Lat", "us") == ["lat", "unnamed:_1", "lat.1"]


def test_seeds(spark, tmp_path):
    assert seed_table_name("file:/x/seeds/us/2022.csv", "/x/seeds") == "us_2022"
    assert seed_table_name("file:/x/seeds/codes.csv", "/x/seeds/") == "codes"
    (tmp_path / "us").mkdir()
    (tmp_path / "us" / "2022.csv").write_text("uid,date\n7,2022-01-01\n")
    (tmp_path / "codes.csv").write_text("code,name\nUS,United States\n")
    seeds = read_seeds(spark, str(tmp_path))
    assert sorted(seeds) == ["codes", "us_2022"]
    assert [tuple(r) for r in seeds["us_2022"].collect()] == [(7, dt.date(2022, 1, 1))]
    (tmp_path / "x" / "us").mkdir(parents=True)
    (tmp_path / "x" / "us" / "2022.csv").write_text("uid\n8\n")
    with pytest.raises(ValueError, match="us_2022"):
        read_seeds(spark, str(tmp_path))
    (tmp_path / "x" / "us" / "2022.csv").unlink()
    (tmp_path / "global.csv").write_text("uid\n8\n")
    with pytest.raises(ValueError, match="global"):
        read_seeds(spark, str(tmp_path))


def test_stream_loads_what_the_batch_loads(spark, landing, bronze, tmp_path):
    mine = shutil.copytree(landing, tmp_path / "landing")
    late = (mine / "us" / "04-15-2020.csv").rename(tmp_path / "04-15-2020.csv")
    root, state = (str(tmp_path / n) for n in ("bronze", "state"))
    run = lambda: ingest_new_reports(spark, str(mine), "us", root, state, batch_files=5).awaitTermination()
    run()
    partial = read_bronze(spark, root, "us")
    assert partial.filter("file_date = '2020-04-15'").count() == 0
    shutil.copy(late, mine / "us" / "04-15-2020.csv")
    run()
    rows = lambda where: sorted(map(str, read_bronze(spark, where, "us").collect()))
    assert rows(root) == rows(bronze[0])
    assert described(read_faults(spark, root, "us").collect()) == FAULTS


def test_stream_loads_a_replaced_file_again(spark, landing, tmp_path):
    mine = shutil.copytree(landing, tmp_path / "landing")
    root, state, whole = (str(tmp_path / n) for n in ("bronze", "state", "whole"))
    run = lambda: ingest_new_reports(spark, str(mine), "us", root, state).awaitTermination()
    run()
    loads = lambda: len(reports.Bronze(spark, root, "us").commits.history())
    before = loads()
    run()  # nothing new: only the list of empty files
    assert loads() == before + 1
    day = dt.date(2020, 4, 13)
    (mine / "us" / "04-13-2020.csv").write_text(US_HEADER + "\n" + us_row("Texas", day, 1))  # replaced
    (mine / "us" / "04-23-2020.csv").write_text(US_HEADER + "\n" + us_row("Ohio", dt.date(2020, 4, 23), 9))  # was unusable
    (mine / "us" / "04-12-2020.csv").write_text("")  # emptied: the earlier rows stay
    (mine / "us" / "04-24-2020.csv").write_text(US_HEADER + "\n" + us_row("Ohio", dt.date(2020, 4, 24), 9))  # new
    run()
    ingest_reports(spark, str(landing), "us", whole)
    ingest_reports(spark, str(mine), "us", whole)
    rows = lambda where: sorted(map(str, read_bronze(spark, where, "us").collect()))
    assert rows(root) == rows(whole)
    empty = [r.file for r in read_faults(spark, root, "us").collect() if r.reason == "empty file"]
    assert sorted(set(empty)) == ["04-12-2020.csv", "04-22-2020.csv"]


def test_listing_has_empty_files_and_no_others(spark, landing):
    listed = {r.path.rsplit("/", 1)[-1]: r.length for r in list_reports(spark, str(landing / "us")).collect()}
    assert listed == {p.name: p.stat().st_size for p in (landing / "us").glob("*.csv")} and listed["04-22-2020.csv"] == 0
    times = {r.path.rsplit("/", 1)[-1]: r.time for r in list_reports(spark, str(landing / "us")).collect()}
    assert times == {p.name: p.stat().st_mtime_ns // 1_000_000 for p in (landing / "us").glob("*.csv")}


def test_listing_without_direct_access_is_the_same(spark, landing, monkeypatch):
    paths = lambda: {(r.path.rsplit("/", 1)[-1], r.length) for r in list_reports(spark, str(landing / "us")).collect()}
    direct = paths()
    monkeypatch.setattr(reports, "_DIRECT_SCHEMES", {})
    assert paths() == direct


def test_ingest_without_direct_access_is_the_same(spark, landing, bronze, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "_DIRECT_SCHEMES", {})
    root = str(tmp_path / "bronze")
    faults = ingest_reports(spark, str(landing), "us", root).collect()
    rows = lambda where: sorted(map(str, read_bronze(spark, where, "us").collect()))
    assert rows(root) == rows(bronze[0]) and described(faults) == FAULTS
