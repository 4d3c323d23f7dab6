"""Command line: ``python -m stopflow {inspect,clean,analyse} ...``.

Paths may be local or any Hadoop-compatible URI; outputs land below
``--out``.  The master and resources come from ``spark-submit`` / the
environment; ``--conf k=v`` adds session settings, and ``--input-bytes``
with ``--cores`` applies :func:`stopflow.session.cluster_conf`.
"""

from __future__ import annotations

import argparse
import json
import sys

from stopflow.plans.jobs import analyse_job, clean_job, inspect_job
from stopflow.session import cluster_conf, get_session
from stopflow.sources.files import largest_file
from stopflow.sources.paths import exists


def _session(args):
    extra = {}
    if args.input_bytes and args.cores:
        extra.update(cluster_conf(args.input_bytes, args.cores))
    for kv in args.conf or []:
        k, _, v = kv.partition("=")
        extra[k] = v
    return get_session(f"stopflow-{args.command}", master=args.master, extra=extra)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="stopflow")
    p.add_argument("--master", default=None)
    p.add_argument("--conf", action="append", help="extra Spark setting k=v (repeatable)")
    p.add_argument("--input-bytes", type=int, default=0, help="raw input size, for partition sizing")
    p.add_argument("--cores", type=int, default=0, help="total executor cores, for partition sizing")
    sub = p.add_subparsers(dest="command", required=True)
    i = sub.add_parser("inspect", help="profile raw inputs")
    i.add_argument("paths", nargs="+")
    i.add_argument("--out", required=True)
    c = sub.add_parser("clean", help="raw feed -> stops.parquet + clean_stats.json")
    c.add_argument("raw", nargs="?", help="the raw schedule feed (file or folder)")
    c.add_argument("--raw-dir", help="folder of raw files: the largest JSON/CSV is the feed; "
                                     "stations.json / trains.json there are used when present")
    c.add_argument("--stations")
    c.add_argument("--trains")
    c.add_argument("--out", required=True)
    a = sub.add_parser("analyse", help="stops.parquet -> result tables + run_summary.json")
    a.add_argument("--out", required=True)
    a.add_argument("--stops", help="defaults to <out>/stops.parquet")
    args = p.parse_args(argv)

    spark = _session(args)
    try:
        if args.command == "inspect":
            ins = inspect_job(spark, args.paths)
            for name, df in ins.nulls.items():
                # inputs that share a last part are named by their whole path
                to = f"{args.out}/inspect/{name.strip('/').replace(':', '').replace('//', '/').replace('/', '__')}"
                df.write.mode("overwrite").parquet(f"{to}/nulls.parquet")
                ins.schemas[name].write.mode("overwrite").parquet(f"{to}/schema.parquet")
                ins.samples[name].write.mode("overwrite").json(f"{to}/sample.json")
            if ins.summary is not None:
                ins.summary.coalesce(1).write.mode("overwrite").json(f"{args.out}/inspect/summary.json")
            print(json.dumps({"profiled": sorted(ins.nulls), "skipped": ins.skipped}))
        elif args.command == "clean":
            raw, stations, trains = args.raw, args.stations, args.trains
            if args.raw_dir:
                d = args.raw_dir.rstrip("/")
                raw = raw or largest_file(spark, d, exclude=("stations.json", "trains.json"))
                # attributes beside the feed are used if they are there; a path given by hand must exist
                stations = stations or (f"{d}/stations.json" if exists(spark, f"{d}/stations.json") else None)
                trains = trains or (f"{d}/trains.json" if exists(spark, f"{d}/trains.json") else None)
            if not raw:
                p.error("clean needs a raw feed or --raw-dir")
            print(json.dumps(clean_job(spark, raw, args.out, stations, trains)))
        else:
            stops = args.stops or f"{args.out}/stops.parquet"
            print(json.dumps(analyse_job(spark, stops, args.out, f"{args.out}/clean_stats.json")))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
