"""Time all queries: one JSON line on stdout.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the local cores; names
given as arguments choose the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES
from tradelane.session import SETTINGS

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    # start the engine before the clock: class loading, code generation, file listing
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    for _ in range(2):
        orders.join(customers, orders.o_custkey == customers.c_custkey).groupBy(
            "c_nationkey", "o_orderdate"
        ).count().orderBy("count").write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
