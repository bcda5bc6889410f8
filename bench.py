"""Time the registered queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local
cores. The stored warehouse that the star, validation and mart queries read is built first and
timed as its own entry, ``load_warehouse``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stratamart.session import local_session  # noqa: E402
from suite.loaded import loaded_warehouse  # noqa: E402
from suite.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}

    def timed(name, work):
        started = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - started, 3)

    timed("load_warehouse", lambda: loaded_warehouse(spark, sf_dir))
    for name, query in QUERIES.items():
        timed(name, lambda query=query: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
