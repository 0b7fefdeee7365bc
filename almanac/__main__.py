"""python -m almanac ingest|run|test --warehouse DIR [...]"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from almanac.plans.registry import run_models, test_models
from almanac.sources.feeds import FEEDS
from almanac.sources.reports import ingest_reports
from almanac.sources.seeds import read_seeds
from almanac.sources.stage import drop_staged
from almanac.sources.warehouse import Warehouse


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="almanac", description="Daily-report tables on Spark.")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("ingest", "seed", "run", "test"):
        command = commands.add_parser(name)
        command.add_argument("--warehouse", required=True, help="root folder of the tables")
        if name in ("ingest", "seed"):
            command.add_argument("--landing", required=True, help="folder of the CSV files")
        else:
            command.add_argument("--tags", default="", help="comma-separated; a table must carry all")
            command.add_argument("--models", default="", help="comma-separated table names")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"almanac {args.command}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        return _run(Warehouse(spark, args.warehouse), args)
    finally:
        drop_staged(spark)


def _run(warehouse: Warehouse, args: argparse.Namespace) -> int:
    spark = warehouse.spark
    if args.command == "ingest":
        left_out = 0
        for feed in FEEDS:
            faults = ingest_reports(spark, args.landing, feed, f"{warehouse.root}/bronze")
            for row in faults.groupBy("left_out", "reason").count().orderBy("left_out", "reason").collect():
                print(f"{feed}: {row['count']} x {row.left_out} left out, {row.reason}")
                left_out += row["count"]
        if left_out:
            print(f"almanac.sources.reports.read_faults has them all")
        return 1 if left_out else 0
    if args.command == "seed":
        warehouse.write_all("bronze", read_seeds(spark, args.landing))
        return 0
    selection = {"tags": args.tags.split(",") if args.tags else [], "names": args.models.split(",") if args.models else []}
    if args.command == "run":
        print("\n".join(run_models(warehouse, **selection)))
        return 0
    results = test_models(warehouse, **selection).collect()
    for r in results:
        print("pass" if r.passed else f"FAIL {r.failures}", f"{r.model}.{r.column}", r.test)
    return 0 if all(r.passed for r in results) else 1


if __name__ == "__main__":
    sys.exit(main())
