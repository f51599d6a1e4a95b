"""Time the registered queries of the core and print one JSON line.

The queries of the llm package are left to the check tool. Every query runs to the end into Spark's ``noop`` sink, plan building and the
jobs it starts included. The tables are scanned once beforehand, so that no
query pays for starting the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterlab.catalog import QUERIES  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Comma-separated names; all queries if unset.
ONLY = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("meterlab-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale() -> float | str:
    name = os.path.basename(FOLDER.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    for table in ("events", "orders", "lineitem"):
        run(spark.read.parquet(f"{FOLDER}/{table}.parquet"))
    seconds = {}
    for name in ONLY or sorted(QUERIES):
        start = time.perf_counter()
        run(QUERIES[name](spark, FOLDER))
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "total seconds of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
