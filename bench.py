"""Wall time of every registered query; prints one JSON line.

`nation_days` and `fact_table` are the times to build the two written tables that marts,
reports and questions read; they are built once, other times do not contain them again.
"""

from __future__ import annotations

import json
import os
import time

from almanac.plans import trade
from almanac.queries import QUERIES
from almanac.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench", **{"spark.sql.shuffle.partitions": cores})
    trade.table(spark, sf_dir, "orders").groupBy("o_orderstatus").count().collect()  # start the JVM's workers

    seconds: dict[str, float] = {}
    for name, build in {"nation_days": trade.built_nation_days, "fact_table": trade.built_fact}.items():
        start = time.perf_counter()
        build(spark, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name, build in QUERIES.items():
        start = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall time of all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
    }))


if __name__ == "__main__":
    main()
