"""Compare every registered query with its check SQL on DuckDB.

usage: python check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from almanac.queries import ORACLES, QUERIES
from almanac.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


SQL_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when names, row counts and all values agree, else what differs."""
    mine = QUERIES[name](spark, sf_dir)
    columns = sorted(mine.columns)
    left = Counter(tuple(map(_cell, row)) for row in mine.select(*[f"`{c}`" for c in columns]).collect())
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {sorted(set(names) ^ set(columns))}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    odd = [f"{f.name}: {f.dataType.simpleString()} / {types[f.name]}" for f in mine.schema.fields
           if SQL_TYPES.get(f.dataType.simpleString()) != types[f.name]]
    if odd:
        return f"types {odd}"
    at = [names.index(c) for c in columns]
    right = Counter(tuple(_cell(row[i]) for i in at) for row in cursor.fetchall())
    if left != right:
        only_left, only_right = left - right, right - left
        return (f"rows {left.total()} / {right.total()}, only here {only_left.total()}: "
                f"{min(only_left, key=str, default=None)} only there: {min(only_right, key=str, default=None)} ({columns})")
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            wrong = difference(spark, con, name, sf_dir)
        except Exception as e:  # report and go on to the next query
            wrong = f"{type(e).__name__}: {str(e)[:600]}"
        bad += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name} {time.time() - start:.2f}s {wrong or ''}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
