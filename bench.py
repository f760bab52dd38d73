"""Time the registered queries on ticks and print one JSON line.

Batch queries: median of three runs after a warm-up, every row computed and
dropped. Stream queries: one run, including landing the table and all
micro-batches. Next to the times stand the scans and exchanges of each batch plan.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickflow.plans.queries import QUERIES  # noqa: E402

BATCH = [name for name in QUERIES if not name.startswith("stream_")]
STREAM = [name for name in QUERIES if name.startswith("stream_")]
WRITES = {"route_counts", "tick_publish"}  # their plans only read back what an earlier job wrote


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    run(QUERIES[name](spark, sf_dir))
    return time.perf_counter() - start


def plan_shape(spark: SparkSession, name: str, sf_dir: str) -> dict[str, int]:
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    return {
        "scans": sum("FileScan" in line for line in lines),
        "exchanges": sum(" Exchange " in f" {line.strip(' +-:')}" for line in lines),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times, plans = {}, {}
    for name in BATCH:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(3)), 3)
        if name not in WRITES:
            plans[name] = plan_shape(spark, name, sf_dir)
    for name in STREAM:
        times[name] = round(seconds(spark, name, sf_dir), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "plans": plans, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
