"""Loads and builds that die, race or change a table under its readers."""

import os
import shutil
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from almanac.sources.bronze import Bronze
from almanac.sources.commits import CommitConflict, Commits
from almanac.sources.warehouse import Warehouse


def cells(spark, days, value):
    rows = [(f"{d:02d}-01-2021.csv", str(value), "Peru") for d in days]
    return spark.createDataFrame(rows, "_file string, confirmed string, country_region string")


def counts(rows):
    return {r.file_date.month: (r.n, r.v) for r in rows.groupBy("file_date").agg(F.count("*").alias("n"), F.max("confirmed").alias("v")).collect()}


def test_head_is_the_highest_complete_commit(spark, tmp_path):
    log = Commits(spark, str(tmp_path / "log"))
    assert log.head() == {} and log.history() == []
    log.commit(lambda state: {"n": 1})
    log.commit(lambda state: {"n": state["n"] + 1})
    assert log.head() == {"n": 2} and [c.number for c in log.history()] == [1, 2]
    (tmp_path / "log" / "000000003.json").write_text('{"n": ')  # a writer that died while it wrote
    assert log.head() == {"n": 2}
    os.utime(tmp_path / "log" / "000000003.json", (1, 1))
    log.commit(lambda state: {"n": state["n"] + 10})
    assert log.head() == {"n": 12} and [c.number for c in log.history()] == [1, 2, 4]


def test_a_faster_writer_is_not_overwritten(spark, tmp_path):
    log = Commits(spark, str(tmp_path / "log"))
    tries = []

    def slow(state):
        tries.append(dict(state))
        if len(tries) == 1:
            Commits(spark, str(tmp_path / "log")).commit(lambda s: {"names": s.get("names", []) + ["fast"]})
        return {"names": state.get("names", []) + ["slow"]}

    log.commit(slow)
    assert log.head() == {"names": ["fast", "slow"]} and tries == [{}, {"names": ["fast"]}]
    always = lambda state: log._create(log._listed()[-1].number + 1, {"names": []}) and {"names": ["late"]}
    with pytest.raises(CommitConflict):
        log.commit(always)


@pytest.mark.parametrize("step", ["_write_list", "commits"])
def test_a_load_that_dies_shows_the_old_state(spark, tmp_path, monkeypatch, step):
    bronze = Bronze(spark, str(tmp_path), "global")
    bronze.load(cells(spark, [1, 2, 3], 5), columns=["confirmed"])
    before = counts(bronze.read(["confirmed"]))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        if step == "commits":
            patched.setattr(Commits, "_create", dies)
        else:
            patched.setattr(Bronze, step, dies)
        with pytest.raises(KeyboardInterrupt):
            bronze.load(cells(spark, [2], 6), cells(spark, [2, 3], 0).select("_file"), ["confirmed", "deaths"], label="again")
    assert counts(bronze.read(["confirmed"])) == before == {1: (1, "5"), 2: (1, "5"), 3: (1, "5")}
    assert bronze.columns() == ["confirmed"] and bronze.faults().count() == 0
    bronze.load(cells(spark, [2], 6), cells(spark, [2, 3], 0).select("_file"), ["confirmed", "deaths"])
    assert counts(bronze.read(["confirmed"])) == {1: (1, "5"), 2: (1, "6")}
    assert bronze.columns() == ["confirmed", "deaths"]


KILLED = """
import os, signal, sys
sys.path[:0] = [{repo!r}, {tests!r}]
from almanac.session import local_session
from almanac.sources import commits, reports
spark = local_session(2, "killed", **{{"spark.checkpoint.dir": {scratch!r}, "spark.sql.warehouse.dir": {scratch!r}}})
commits.Commits._create = lambda *_: os.kill(os.getpid(), signal.SIGKILL)
reports.ingest_reports(spark, {landing!r}, "us", {bronze!r})
"""


def test_a_killed_process_shows_the_old_state(spark, tmp_path):
    from report_files import US_HEADER, us_row, write_landing
    import datetime as dt

    from almanac.sources.reports import ingest_reports, read_bronze, read_faults

    landing, root = write_landing(tmp_path / "landing"), str(tmp_path / "bronze")
    ingest_reports(spark, str(landing), "us", root)
    rows = lambda: sorted(map(str, read_bronze(spark, root, "us").collect()))
    before, faults = rows(), read_faults(spark, root, "us").count()
    (landing / "us" / "04-13-2020.csv").write_text(US_HEADER + "\n" + us_row("Texas", dt.date(2020, 4, 13), 1))
    repo = Path(__file__).resolve().parent.parent
    code = KILLED.format(repo=str(repo), tests=str(repo / "tests"), scratch=str(tmp_path / "scratch"), landing=str(landing), bronze=root)
    assert subprocess.run([sys.executable, "-c", code], capture_output=True).returncode == -9
    loads = [p.name for p in (tmp_path / "bronze" / "us").iterdir()]
    assert len(loads) == 2  # the rows of the load that died are there, and not seen
    assert rows() == before and read_faults(spark, root, "us").count() == faults
    ingest_reports(spark, str(landing), "us", root)
    assert rows() != before
    bronze = Bronze(spark, root, "us")
    after = rows()
    bronze.clean(keep_hours=0)
    assert rows() == after and read_faults(spark, root, "us").count() > 0
    assert len([p for p in (tmp_path / "bronze" / "us").iterdir() if p.name.startswith("load=")]) < 3


def test_readers_go_on_while_a_table_changes(spark, tmp_path):
    bronze = Bronze(spark, str(tmp_path), "global")
    bronze.load(cells(spark, [1, 2], 5))
    reader = bronze.read(["confirmed"])
    bronze.load(cells(spark, [2], 6))
    bronze.load(cells(spark, [1], 7), cells(spark, [1, 2], 0).select("_file"))
    assert counts(reader) == {1: (1, "5"), 2: (1, "5")} and counts(bronze.read(["confirmed"])) == {1: (1, "7")}
    bronze.clean(keep_hours=1)
    assert counts(reader) == {1: (1, "5"), 2: (1, "5")}
    time.sleep(0.01)
    bronze.clean(keep_hours=0)
    assert counts(bronze.read(["confirmed"])) == {1: (1, "7")}
    assert len([p for p in (tmp_path / "global").iterdir() if p.name.startswith("load=")]) == 1
    bronze.load(cells(spark, [3], 8))
    assert counts(bronze.read(["confirmed"])) == {1: (1, "7"), 3: (1, "8")}

    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.write("gold", "t", spark.range(3))
    reader = wh.read("gold", "t")
    wh.write("gold", "t", spark.range(5))
    wh.write("gold", "t", spark.range(7))
    assert (reader.count(), wh.read("gold", "t").count(), spark.table("gold.t").count()) == (3, 7, 7)
    stays = [p for p in (tmp_path / "wh" / "gold" / "t").iterdir() if p.name.startswith("v-")]
    assert len(stays) == 3
    Warehouse(spark, str(tmp_path / "wh"), keep_hours=0).clean("gold", "t")
    stays = [p for p in (tmp_path / "wh" / "gold" / "t").iterdir() if p.name.startswith("v-")]
    assert len(stays) == 1 and wh.read("gold", "t").count() == 7


def test_a_load_without_rows_and_an_unknown_feed(spark, tmp_path):
    bronze = Bronze(spark, str(tmp_path), "global")
    with pytest.raises(FileNotFoundError):
        bronze.read()
    assert not bronze.loaded() and bronze.faults().count() == 0
    bronze.load(cells(spark, [], 1), columns=["confirmed"])
    assert bronze.read().count() == 0
    bronze.load(cells(spark, [4], 1), columns=["confirmed"])
    bronze.load(cells(spark, [], 1), cells(spark, [4], 1).select("_file"))
    assert bronze.read().count() == 0
    shutil.rmtree(tmp_path / "global")  # nothing that counts was in it
    assert bronze.read().count() == 0
