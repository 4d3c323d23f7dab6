"""Write the physical plans of the headline queries as Markdown (PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each plan is the executed (final adaptive) plan after one run, cut to the
operator lines (expression lists shortened) so that the shape is readable:
exchanges, aggregates, joins, scans with their pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"(Exchange|Aggregate|Join|FileScan|TakeOrdered|Window|Sort |Sort\[|Expand|Generate|Union|"
                  r"BroadcastExchange|ReusedExchange|AQEShuffleRead|Subquery|CollectLimit|Filter)")


def shorten(line: str, width: int = 160) -> str:
    line = re.sub(r"#\d+L?", "", line)
    scan = re.match(r"^(.*FileScan \w+ \[[^\]]*\]).*?(PushedFilters: \[[^\]]*\])", line)
    if scan:
        return scan.group(1) + " " + scan.group(2)
    line = re.sub(r"Location: [^,]+, ", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    return line if len(line) <= width else line[: width - 3] + "..."


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from stopflow.operators import analytics as A
    from stopflow.operators import lookup as L
    from stopflow.plans import fixture as X
    from stopflow.plans import queries as Q
    from stopflow.session import get_session, scratch_path
    from stopflow.sinks import publish as W
    spark = get_session("plan-report", master="local[8]", shuffle_partitions=8)

    stops_path = scratch_path(spark, "plan_report_stops")
    W.write_table(Q.stops(spark, sf_dir), stops_path, cluster_by=["station_name", "train_number"],
                  bloom_filter_columns=["train_number", "station_code"])
    stops = spark.read.parquet(stops_path)
    cases = {
        "clean + enrich (from the base tables)": Q.stops(spark, sf_dir),
        "removal accounting (one aggregate)": Q.QUERIES["clean_stats"](spark, sf_dir),
        "busiest stations (published stops)": A.busiest_stations(stops),
        "dwell statistics (published stops)": A.stoppage_stats(stops),
        "dense hourly traffic (published stops)": A.hourly_traffic_dense(stops),
        "train catalogue (published stops)": L.train_catalog(stops),
        "catalogue search with fallback": L.train_search_fallback(L.train_catalog(stops), "zzz"),
        "station timetable lookup (published stops)": L.station_timetable(stops, "Supplier#000000003", period="Evening"),
        "route itinerary lookup (published stops)": L.route_itinerary(stops, "1102"),
        "halt numbers (skew-safe numbering)": L.route_halt_number(stops),
        "train profiles (every train card, one shuffle)": L.train_profiles(stops),
        "station profiles (every station page)": L.station_profiles(stops),
        "raw feed derivation": X.raw_stops(spark, sf_dir),
    }
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `python tools/plan_report.py {sf_dir}` (local[8], 8 shuffle partitions, AQE on). "
          "Operator lines only; expression ids and long argument lists are cut.\n")
    for title, df in cases.items():
        df.collect() if df.count() <= 100000 else None
        text = df._jdf.queryExecution().executedPlan().toString()
        lines = [shorten(ln) for ln in text.split("\n") if KEEP.search(ln)]
        if "== Final Plan ==" in text:
            final = text.split("== Initial Plan ==")[0]
            lines = [shorten(ln) for ln in final.split("\n") if KEEP.search(ln)]
        print(f"## {title}\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
