"""Hot-key experiment: one train holds a third of all stops.

Usage: python tools/skew_check.py [sf_dir]

Derives a raw feed from the fixture in which every third stop belongs to
train "HOT", runs the clean job, the analyse job and the halt numbering
with the event log on, and prints per stage: tasks, the largest task's
share of the stage's shuffle read and its duration against the median
task.  Balanced stages keep the largest share near 1/tasks.
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from event_report import _lines  # noqa: E402


def stage_balance(log_dir: str) -> list[dict]:
    import json
    tasks = defaultdict(list)
    names = {}
    for line in _lines(log_dir):
        ev = json.loads(line)
        if ev.get("Event") == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description", "")
            for sid in ev.get("Stage IDs", []):
                names[sid] = desc
        if ev.get("Event") != "SparkListenerTaskEnd":
            continue
        m = ev.get("Task Metrics") or {}
        sr = m.get("Shuffle Read Metrics") or {}
        rd = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
        info = ev["Task Info"]
        tasks[ev["Stage ID"]].append((rd, info["Finish Time"] - info["Launch Time"]))
    out = []
    for sid, ts in sorted(tasks.items()):
        total = sum(r for r, _ in ts)
        if total == 0 or len(ts) < 2:
            continue
        durs = [d for _, d in ts]
        out.append({"stage": sid, "name": names.get(sid, ""), "tasks": len(ts), "shuffle_read": total,
                    "max_share": round(max(r for r, _ in ts) / total, 3),
                    "max_ms": max(durs), "median_ms": int(statistics.median(durs))})
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from stopflow.operators import lookup as L
    from stopflow.plans import fixture as X
    from stopflow.plans.jobs import analyse_job, clean_job
    from stopflow.schema import RAW_STOPS_JSON
    from stopflow.session import get_session, scratch_path
    from stopflow.sources.geojson import to_feature_collections

    logs = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    # Small advisory partitions emulate a large cluster's fan-out, so that an
    # imbalance would show instead of being coalesced away.
    spark = get_session("skew-check", master="local[8]", shuffle_partitions=64,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logs}",
                               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
                               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4m"})
    root = scratch_path(spark, "skew")
    raw = X.raw_stops(spark, sf_dir)
    is_hot = F.col("id") % 3 == 0
    hot = (raw.withColumn("number", F.when(is_hot, F.lit("HOT")).otherwise(F.col("number")))
              .withColumn("trainName", F.when(is_hot, F.lit("Hot Express")).otherwise(F.col("trainName"))))
    hot.write.json(f"{root}/raw")
    to_feature_collections(X.station_meta(spark, sf_dir)).write.json(f"{root}/stations")
    to_feature_collections(X.train_meta(spark, sf_dir)).write.json(f"{root}/trains")
    sc = spark.sparkContext
    sc.setJobDescription("clean job")
    stats = clean_job(spark, f"{root}/raw", f"{root}/out", f"{root}/stations", f"{root}/trains", RAW_STOPS_JSON)
    sc.setJobDescription("analyse job")
    summary = analyse_job(spark, f"{root}/out/stops.parquet", f"{root}/out", f"{root}/out/clean_stats.json",
                          parallel_jobs=1)
    stops = spark.read.parquet(f"{root}/out/stops.parquet")
    sc.setJobDescription("halt numbers")
    halts = L.route_halt_number(stops)
    top = halts.filter("train_number = 'HOT'").agg(F.max("halt_no"), F.count(F.lit(1))).first()
    longest = spark.read.parquet(f"{root}/out/longest_trains.parquet").orderBy(F.desc("num_stops")).first()
    spark.stop()
    print(f"clean: {stats}")
    print(f"HOT train: {longest.num_stops} stops (of {summary['cleaned_rows']}); halt numbers 1..{top[0]} over {top[1]} rows")
    print(f"{'stage':>5} {'tasks':>5} {'max_share':>9} {'max_ms':>7} {'med_ms':>7}  name")
    for r in stage_balance(logs):
        print(f"{r['stage']:>5} {r['tasks']:>5} {r['max_share']:>9} {r['max_ms']:>7} {r['median_ms']:>7}  {r['name']}")


if __name__ == "__main__":
    main(sys.argv)
