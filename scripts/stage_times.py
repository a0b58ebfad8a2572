"""Per-stage wall times of one registered query, read from Spark's event log.

Usage: python scripts/stage_times.py <query> [sf_dir] [runs]

The event log is written to a fresh scratch folder; the last run is reported.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from tillroll.plans.queries import QUERIES  # noqa: E402
from tillroll.session import ensure_checkpoint_dir  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    runs = int(sys.argv[3]) if len(sys.argv) > 3 else 3
    logs = tempfile.mkdtemp(prefix="run-events-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, os.path.join(logs, "ckpt"))
    marks = []
    for i in range(runs):
        spark.sparkContext.setLocalProperty("tillroll.run", str(i))
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        t1 = time.time()
        df.write.format("noop").mode("overwrite").save()
        t2 = time.time()
        marks.append((t0, t1, t2))
    spark.stop()
    start = None
    print(f"build {marks[-1][1] - marks[-1][0]:.3f}s run {marks[-1][2] - marks[-1][1]:.3f}s")
    stages = {}
    jobs = {}
    paths = sorted(p for p in glob.glob(os.path.join(logs, "**", "*"), recursive=True) if os.path.isfile(p) and "ckpt" not in p)
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    if start is not None and info.get("Submission Time", 0) >= start:
                        stages[info["Stage ID"]] = (
                            info["Submission Time"] - start,
                            info["Completion Time"] - info["Submission Time"],
                            info["Number of Tasks"],
                            info["Stage Name"][:60],
                        )
                elif kind == "SparkListenerJobStart":
                    props = ev.get("Properties", {})
                    if props.get("tillroll.run") == str(runs - 1):
                        start = ev["Submission Time"] if start is None else start
                        jobs[ev["Job ID"]] = ev["Submission Time"] - start
    if True:
        for jid, at in sorted(jobs.items()):
            print(f"job {jid} submitted at +{at} ms")
        for sid, (at, dur, ntasks, label) in sorted(stages.items()):
            print(f"stage {sid:4d} at +{at:6d} ms  {dur:6d} ms  {ntasks:4d} tasks  {label}")


if __name__ == "__main__":
    main()
