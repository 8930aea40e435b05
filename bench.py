"""Time every query: one JSON line on standard output.

The folder is $BENCH_SF_DIR, the cores $BENCH_CPUS; $BENCH_ONLY may name some queries. Each
query runs once cold, then $BENCH_RUNS times; the fastest of those counts. Results are
computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from noticemill import catalog
from noticemill.fixtures import LANDED, Fixtures
from noticemill.session import configure


def run(query, spark, folder) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("noticemill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    tables = Fixtures(spark, folder)
    for name in LANDED:
        getattr(tables, name)
    landing = time.perf_counter() - start

    cold, warm = {}, {}
    for name, query in catalog.queries().items():
        if only and name not in only:
            continue
        cold[name] = round(run(query, spark, folder), 3)
        warm[name] = round(min(run(query, spark, folder) for _ in range(max(runs, 1))), 3)
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "sum of query times, warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "landing": round(landing, 3),
                "cpus": cpus,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
