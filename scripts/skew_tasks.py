"""Per-task shuffle-read records of the team-form window, on an
input where one team holds about a third of all rows.  Uses Spark's event log
in a fresh scratch folder (no UI).

Usage: python scripts/skew_tasks.py [sf_dir] [buckets]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    buckets = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    logdir = tempfile.mkdtemp(prefix="run-eventlog-")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .getOrCreate())
    from touchline import fixtures as fx
    from touchline.operators.form import build_team_form

    m = fx.matches(spark, sf, n_teams=1000)
    k = F.col("match_id").cast("bigint")
    skewed = (m.withColumn("home_team_id", F.when(k % 3 == 0, F.lit("0")).otherwise(F.col("home_team_id")))
               .withColumn("away_team_id", F.when(k % 3 == 1, F.lit("0")).otherwise(F.col("away_team_id")))
               .filter(F.col("home_team_id") != F.col("away_team_id")))
    sc = spark.sparkContext
    sc.setJobGroup("form", "form")
    build_team_form(skewed, keep_unscored=True, buckets=buckets).write.format("noop").mode("overwrite").save()
    spark.stop()

    # job group -> stages -> task shuffle-read records
    job_group, stage_job, tasks = {}, {}, {}
    for path in glob.glob(f"{logdir}/*"):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = grp
                elif kind == "SparkListenerTaskEnd":
                    tm = ev.get("Task Metrics") or {}
                    rec = (tm.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks.setdefault(ev["Stage ID"], []).append(rec)
    out = {}
    for sid, recs in tasks.items():
        grp = stage_job.get(sid)
        if not grp or max(recs) == 0:
            continue
        recs = sorted(recs)
        cur = out.get(grp)
        if cur is None or max(recs) > cur["max_task_records"]:
            out[grp] = {"stage": sid, "tasks": len(recs), "max_task_records": recs[-1],
                        "median_task_records": recs[len(recs) // 2], "total_records": sum(recs)}
    print(json.dumps(out, indent=1))


if __name__ == "__main__":
    main()
