"""Summarise a Spark event log: wall time per job and the slowest stages.

    python tools/stage_times.py <event log file or folder> [top_n]

Reads the JSON-lines event log Spark writes with ``spark.eventLog.enabled`` (no UI or
REST interface involved).
"""

from __future__ import annotations

import json
import os
import sys


def _events(path: str):
    if os.path.isdir(path):  # Spark 4 rolls logs into eventlog_v2_*/events_N_* folders
        files = sorted(os.path.join(root, f) for root, _, names in os.walk(path)
                       for f in names if f.startswith(("events", "local-", "app-")))
    else:
        files = [path]
    for f in files:
        if f.endswith(".zstd"):  # Spark compresses event logs with zstd by default
            import zstandard

            with open(f, "rb") as raw:
                data = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
            lines = data.decode("utf-8").splitlines()
        else:
            with open(f) as fh:
                lines = fh.read().splitlines()
        for line in lines:
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    jobs, stages, descr = {}, [], {}
    for e in _events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            jobs[e["Job ID"]] = [e["Submission Time"], None, len(e.get("Stage IDs", []))]
            descr[e["Job ID"]] = (props.get("spark.job.description") or props.get("callSite.short") or "")[:60]
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if info.get("Completion Time") and info.get("Submission Time"):
                stages.append((info["Completion Time"] - info["Submission Time"], info["Stage ID"],
                               info["Number of Tasks"], info["Stage Name"][:70]))
    total = sum((end - start) for start, end, _ in jobs.values() if end)
    print(f"jobs: {len(jobs)}, summed job wall time: {total / 1000:.1f}s, stages: {len(stages)}")
    print("slowest stages (ms, id, tasks, name):")
    for ms, sid, ntask, name in sorted(stages, reverse=True)[:top]:
        print(f"  {ms:7d}  {sid:5d}  {ntask:5d}  {name}")


if __name__ == "__main__":
    main()
