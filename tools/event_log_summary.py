"""Summarize a Spark event log: per job, wall time, stages and task time.

Usage: python tools/event_log_summary.py <event log file or rolling log folder>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as fh:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
                yield from text
        else:
            with open(f) as fh:
                yield from fh


def main() -> None:
    jobs, stage_tasks, stage_names, job_stages = {}, defaultdict(float), {}, {}
    desc = {}
    for line in _lines(sys.argv[1]):
        if True:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None]
                job_stages[e["Job ID"]] = [s["Stage ID"] for s in e["Stage Infos"]]
                props = e.get("Properties") or {}
                desc[e["Job ID"]] = (props.get("spark.job.description") or props.get("callSite.short") or "")[:60]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerTaskEnd":
                info = e["Task Info"]
                stage_tasks[e["Stage ID"]] += (info["Finish Time"] - info["Launch Time"]) / 1000.0
            elif ev == "SparkListenerStageCompleted":
                stage_names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:50]
    for j, (start, end) in sorted(jobs.items()):
        task = sum(stage_tasks[s] for s in job_stages[j])
        print(f"job {j:4d} wall {((end or start) - start) / 1000:6.2f}s task {task:6.2f}s "
              f"stages {len(job_stages[j])} {desc[j]}")


if __name__ == "__main__":
    main()
