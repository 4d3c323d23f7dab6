"""Per-job stage report from a Spark event log (no UI needed).

Usage:
  python tools/event_report.py <event-log file or folder>

Run any job with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<scratch folder>``; this prints, per job, its
description, wall time, task count, input bytes and shuffle read/write bytes.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event-log lines from a file or a Spark 4 rolling log folder (optionally zstd)."""
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def report(path: str) -> list[dict]:
    jobs: dict[int, dict] = {}
    stage_job: dict[int, int] = {}
    agg = defaultdict(lambda: defaultdict(int))
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                jid = ev["Job ID"]
                props = ev.get("Properties") or {}
                desc = props.get("spark.job.description") or props.get("callSite.short") or ""
                jobs[jid] = {"job": jid, "desc": desc[:60], "start": ev["Submission Time"]}
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = jid
            elif kind == "SparkListenerJobEnd":
                if ev["Job ID"] in jobs:
                    jobs[ev["Job ID"]]["ms"] = ev["Completion Time"] - jobs[ev["Job ID"]]["start"]
            elif kind == "SparkListenerTaskEnd":
                jid = stage_job.get(ev["Stage ID"])
                if jid is None:
                    continue
                m = ev.get("Task Metrics") or {}
                a = agg[jid]
                a["tasks"] += 1
                a["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                a["shuffle_read"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                a["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    out = []
    for jid, j in sorted(jobs.items()):
        j.update(agg[jid])
        out.append(j)
    return out


def main(argv):
    rows = report(argv[1])
    print(f"{'job':>4} {'ms':>6} {'tasks':>5} {'input':>10} {'shuf_rd':>10} {'shuf_wr':>10}  description")
    for r in rows:
        print(f"{r['job']:>4} {r.get('ms', 0):>6} {r.get('tasks', 0):>5} {r.get('input', 0):>10} "
              f"{r.get('shuffle_read', 0):>10} {r.get('shuffle_write', 0):>10}  {r['desc']}")


if __name__ == "__main__":
    main(sys.argv)
