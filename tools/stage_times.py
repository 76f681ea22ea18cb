"""Run registered queries with Spark's event log on and print per-stage durations.

Usage: python tools/stage_times.py SF_DIR QUERY [QUERY ...]
The event log goes to a fresh scratch folder (no UI, no server).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    ev = tempfile.mkdtemp(prefix="lastmile-events-")
    from lastmile.plans.catalog import QUERIES
    from lastmile.session import build_session
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev, "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    QUERIES["kpi_daily"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    marks = []
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        t1 = time.time()
        df.write.format("noop").mode("overwrite").save()
        t2 = time.time()
        marks.append((name, t0, t1, t2))
        print(f"== {name}: build {t1 - t0:.2f}s run {t2 - t1:.2f}s")
    spark.stop()
    stages = []
    for f in glob.glob(os.path.join(ev, "**", "*"), recursive=True):
        if os.path.isdir(f) or "appstatus" in f:
            continue
        for line in open(f, encoding="utf-8"):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages.append((si["Submission Time"] / 1000, (si["Completion Time"] - si["Submission Time"]) / 1000,
                               si["Number of Tasks"], si["Stage ID"], si["Stage Name"][:60]))
    for name, t0, _, t2 in marks:
        print(f"-- stages of {name}")
        for s in sorted(x for x in stages if t0 <= x[0] <= t2):
            print(f"   +{s[0] - t0:6.2f}s dur={s[1]:5.2f}s tasks={s[2]:4d} stage={s[3]} {s[4]}")


if __name__ == "__main__":
    main()
