"""Hot-key check: one user holds a third of all history rows.

Runs the state-change gap computation twice over such data (derived from the
events table: every third event is reassigned to user 0) — once with the
split window of ``previous_in_sequence`` and once with a plain per-user
window — and reports, from Spark's event log, the largest share of rows any
single task of the window stage had to read.

usage: python tools/skew_check.py [sf_dir] [event_log_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallyframe.operators.states import change_gaps  # noqa: E402
from tallyframe.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else "/tmp/skew-eventlog"
    os.makedirs(log_dir, exist_ok=True)
    spark = get_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    n = hot.count()

    spark.sparkContext.setJobGroup("split", "split window")
    split = change_gaps(hot, "user_id", "ts", "event_type", tie_cols=["event_id"]).agg(F.avg("gap_days")).first()[0]
    spark.sparkContext.setJobGroup("plain", "plain window")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    prev = hot.withColumn("pt", F.lag("event_type").over(w)).withColumn("pts", F.lag("ts").over(w))
    plain = (prev.where(F.col("pts").isNotNull() & ~(F.col("pt") == F.col("event_type")).eqNullSafe(True))
             .agg(F.avg(F.datediff(F.to_date("ts"), F.to_date("pts")))).first()[0])
    spark.stop()

    path = sorted(glob.glob(os.path.join(log_dir, "*", "events_*")), key=os.path.getmtime)[-1]
    job_group, stage_group, task_max, task_sum = {}, {}, {}, {}
    for line in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8"):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e["Stage IDs"]:
                stage_group[sid] = g
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            rec = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            sid = e["Stage ID"]
            task_max[sid] = max(task_max.get(sid, 0), rec)
            task_sum[sid] = task_sum.get(sid, 0) + rec
    for g in ("split", "plain"):
        worst = max((task_max[s] / n, s) for s in task_max if stage_group.get(s) == g and task_sum[s] >= n * 0.9)
        print(json.dumps({"window": g, "rows": n, "largest_task_share_of_rows": round(worst[0], 3)}))
    assert abs(split - plain) < 1e-9, (split, plain)


if __name__ == "__main__":
    main()
