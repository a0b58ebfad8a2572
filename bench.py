"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is timed end to end (building the DataFrame plus running it to
completion through the ``noop`` sink, so no rows are collected). ``cold`` has each
query's first run in the session (file listing, footer reads, code generation),
``queries`` the median of ``$BENCH_RUNS`` (default 3) runs after it.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from tillroll.plans.queries import QUERIES  # noqa: E402
from tillroll.session import ensure_checkpoint_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="tillroll-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillroll-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))

    names = [n for n in QUERIES if not only or n in only]

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    cold = {name: once(name) for name in names}
    timings = {name: statistics.median(once(name) for _ in range(runs)) for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "cold": {k: round(v, 3) for k, v in cold.items()},
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
