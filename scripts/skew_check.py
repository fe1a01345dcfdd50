"""Per-task load of the date statistics when one date holds a third of the rows.

    python scripts/skew_check.py [sf_dir]

Observations come from the ``lineitem`` mapping; about every third one (by
a hash of its values) is moved onto one date, so that date holds a third of
all pixels.  Spark's one-pass ``percentile`` and the exact distributed path
run on the same table, with the event log written to a fresh scratch folder;
for each run the script reports, for the stage with the most shuffle bytes,
the share of them read by its busiest task.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rastercube.operators.stats import date_stats  # noqa: E402
from rastercube.session import build_session  # noqa: E402
from rastercube.sources import testdata as td  # noqa: E402


def hottest_task(log_dir: str, group: str) -> dict:
    """For the shuffle-reading stage of ``group`` with the most bytes: its
    total shuffle read, the largest single task's read and that task's share."""
    stages, per_stage = set(), {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith(("appstatus", ".")):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    if (ev.get("Properties") or {}).get("spark.jobGroup.id") == group:
                        stages.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stages:
                    sr = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                    per_stage.setdefault((ev["Stage ID"], ev.get("Stage Attempt ID", 0)), []).append(read)
    if not per_stage:
        return {}
    reads = max(per_stage.values(), key=sum)
    total = sum(reads)
    return {
        "stage_shuffle_read_bytes": total,
        "stage_tasks": len(reads),
        "hottest_task_bytes": max(reads),
        "hottest_task_share": round(max(reads) / total, 3) if total else 0.0,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="rastercube-eventlog-")
    spark = build_session(
        "local[8]",
        conf={
            "spark.sql.shuffle.partitions": "16",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            # keep the 16 hash partitions visible (no coalescing into few tasks)
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    obs = td.obs(spark, sf_dir)
    # about every third observation onto one date (same mapping, date replaced)
    skewed = obs.withColumn(
        "date", F.when(F.abs(F.hash("row", "col", "red", "nir")) % 3 == 0, F.lit("1998-01")).otherwise(F.col("date"))
    ).persist()
    n = skewed.count()
    hot = skewed.filter(F.col("date") == "1998-01").count()
    result = {"rows": n, "hot_date_rows": hot}
    for method in ["builtin", "exact", "builtin", "exact"]:
        spark.sparkContext.setJobGroup(method, method)
        t = time.time()
        date_stats(skewed, method=method).collect()
        result.setdefault(method, {})["sec"] = round(time.time() - t, 2)
    spark.stop()
    for method in ["builtin", "exact"]:
        result[method].update(hottest_task(log_dir, method))
    print(json.dumps(result))


if __name__ == "__main__":
    main()
