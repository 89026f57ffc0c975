"""Stage / shuffle summary of registered queries from Spark's event log.

Usage: python tools/eventlog.py [sf_dir] name [name ...]
The event log goes to a fresh scratch folder (mktemp); no UI is started.
Per query: jobs, stages, summed task time, shuffle write bytes, input bytes.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voxelframe.plans import catalog  # noqa: E402
from voxelframe.session import build_session  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if a != "-v"]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
                                                  "spark.eventLog.dir": logdir})
    qs = catalog.queries()
    marks = []
    for name in args:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        qs[name](spark, sf).write.format("noop").mode("overwrite").save()
        marks.append((name, time.perf_counter() - t0))
    spark.stop()
    log = glob.glob(os.path.join(logdir, "*"))[0]
    parts = sorted(glob.glob(os.path.join(log, "events_*"))) if os.path.isdir(log) else [log]

    def lines():
        for p in parts:
            yield from open(p)
    job_group, stage_group = {}, {}
    acc = {}
    stage_ms, stage_name = {}, {}
    for line in lines():
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stage_name[info["Stage ID"]] = ", ".join(r["Name"] for r in info.get("RDD Info", [])[:3])
        if ev == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            job_group[e["Job ID"]] = g
            for s in e.get("Stage IDs", []):
                stage_group[s] = g
            acc.setdefault(g, {"jobs": 0, "stages": set(), "task_ms": 0, "shuffle_w": 0, "input": 0})["jobs"] += 1
        elif ev == "SparkListenerTaskEnd":
            g = stage_group.get(e["Stage ID"])
            if g is None:
                continue
            a = acc[g]
            a["stages"].add(e["Stage ID"])
            m = e.get("Task Metrics") or {}
            a["task_ms"] += m.get("Executor Run Time", 0)
            stage_ms[e["Stage ID"]] = stage_ms.get(e["Stage ID"], 0) + m.get("Executor Run Time", 0)
            a["shuffle_w"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            a["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
    for name, sec in marks:
        a = acc.get(name, {"jobs": 0, "stages": set(), "task_ms": 0, "shuffle_w": 0, "input": 0})
        print(f"{name:24s} wall={sec:6.2f}s jobs={a['jobs']:3d} stages={len(a['stages']):3d} "
              f"task={a['task_ms'] / 1000:7.2f}s shuffle_write={a['shuffle_w'] / 1e6:8.2f}MB "
              f"input={a['input'] / 1e6:8.2f}MB")
        if "-v" in sys.argv:
            top = sorted(a["stages"], key=lambda x: -stage_ms.get(x, 0))[:6]
            for st in top:
                print(f"      stage {st:4d} task={stage_ms.get(st, 0) / 1000:6.2f}s  {stage_name.get(st, '')[:110]}")


if __name__ == "__main__":
    main()
