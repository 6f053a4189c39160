"""Shuffle and task summary per query from Spark's event log (written to a scratch folder).

usage: python tools/stage_report.py [--sf DIR] name [name ...]

For each query: number of jobs and stages, input bytes, shuffle bytes written and read,
bytes spilled, and the largest task's share of the shuffle records of its stage, over
stages with at least four tasks reading a shuffle (a skew indicator; 1/tasks is even).
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(log_file: str) -> dict:
    out = {"jobs": 0, "stages": 0, "input_bytes": 0, "shuffle_write_bytes": 0, "shuffle_read_bytes": 0,
           "spill_bytes": 0, "max_task_record_share": 0.0}
    per_stage: dict[int, list[int]] = {}
    with open(log_file) as f:
        for line in f:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                out["jobs"] += 1
            elif kind == "SparkListenerStageCompleted":
                out["stages"] += 1
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                out["input_bytes"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                sw = m.get("Shuffle Write Metrics") or {}
                sr = m.get("Shuffle Read Metrics") or {}
                out["shuffle_write_bytes"] += sw.get("Shuffle Bytes Written", 0)
                out["shuffle_read_bytes"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                out["spill_bytes"] += m.get("Disk Bytes Spilled", 0)
                # skew is judged on what shuffles deliver to each task (scan splits follow the
                # files' row groups, which the job does not choose)
                if sr.get("Total Records Read", 0):
                    per_stage.setdefault(ev["Stage ID"], []).append(sr.get("Total Records Read", 0))
    for recs in per_stage.values():
        total = sum(recs)
        # stages AQE coalesced to one or two tasks say nothing about skew
        if total > 1000 and len(recs) >= 4:
            out["max_task_record_share"] = max(out["max_task_record_share"], round(max(recs) / total, 3))
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    from pyspark.sql import SparkSession

    from scriptorium.plans import load_all
    from scriptorium.session import ensure_checkpoint_dir

    queries, _ = load_all()
    for name in args.names:
        logdir = tempfile.mkdtemp(prefix="eventlog-")
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "16").config("spark.sql.adaptive.enabled", "true")
                 .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
                 .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        ensure_checkpoint_dir(spark)
        queries[name](spark, args.sf).write.format("noop").mode("overwrite").save()
        spark.stop()
        logs = [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]
        print(json.dumps({"query": name, **summarise(sorted(logs)[0])}))


if __name__ == "__main__":
    main()
