"""Benchmark of the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 3, median is
reported, after one warm-up run; streams are run once after the warm-up). Times include planning
and, for streams, storing their input.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tillstream.plans.queries import QUERIES
from tillstream.session import local_session

BATCH = ["line_subtotals", "basket_totals", "basket_assembly", "cdc_latest", "sales_completed", "sales_completed_1h",
         "sales_completed_changelog", "unnested_sales", "unnested_sales_upsert"]
STREAMS = ["upsert_payments", "upsert_completed", "stream_sales_completed", "stream_sales_completed_1h"]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    times = {}
    for name in sys.argv[1:] or BATCH + STREAMS:
        run(spark, sf_dir, name)
        repeats = runs if name in BATCH else 1
        times[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(repeats)), 3)
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1],
                      "lines_per_second": {n: round(lines / t) for n, t in times.items()}}))


if __name__ == "__main__":
    main()
