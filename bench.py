"""Benchmark: the clean and analyse jobs plus the explorer lookups.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_SHUFFLE`` (shuffle partitions, default 2 per core; AQE
coalesces).  Setup (untimed) lands the derived raw feed as line-delimited
JSON and the station/train attributes as GeoJSON FeatureCollections in the
shared folder; then the jobs run exactly as a user would run them on files.
Prints one JSON line.  ``value`` is clean + analyse wall time; the
``analyse.*`` entries are per-output wall times of jobs that run
concurrently, so they overlap and do not add up to ``analyse_job``.
``warm`` repeats both jobs once more (steady state after JIT warm-up).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from stopflow.operators import lookup as L  # noqa: E402
from stopflow.operators import slicers as S  # noqa: E402
from stopflow.plans import fixture as X  # noqa: E402
from stopflow.plans.jobs import analyse_job, clean_job  # noqa: E402
from stopflow.schema import RAW_STOPS_JSON  # noqa: E402
from stopflow.session import get_session, scratch_path  # noqa: E402
from stopflow.sources.geojson import to_feature_collections  # noqa: E402


def _sf(sf_dir: str):
    tail = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(tail)
    except ValueError:
        return tail


def timed(fn):
    t0 = time.time()
    out = fn()
    return out, round(time.time() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session("stopflow-bench", master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", 2 * cpus)),
                        extra={"spark.driver.memory": "8g"})
    root = scratch_path(spark, "bench")
    raw_dir, stn_dir, trn_dir, out_dir = (f"{root}/{n}" for n in ("raw_stops", "stations", "trains", "out"))

    # --- setup (untimed): land the inputs as files ---
    X.raw_stops(spark, sf_dir).write.mode("overwrite").json(raw_dir)
    to_feature_collections(X.station_meta(spark, sf_dir)).write.mode("overwrite").json(stn_dir)
    to_feature_collections(X.train_meta(spark, sf_dir)).write.mode("overwrite").json(trn_dir)

    q: dict[str, float] = {}
    stats, q["clean_job"] = timed(lambda: clean_job(spark, raw_dir, out_dir, stn_dir, trn_dir, RAW_STOPS_JSON))
    per_output: dict[str, float] = {}
    summary, q["analyse_job"] = timed(lambda: analyse_job(spark, f"{out_dir}/stops.parquet", out_dir,
                                                          f"{out_dir}/clean_stats.json", per_output))
    q.update({f"analyse.{k}": v for k, v in per_output.items()})

    stops = spark.read.parquet(f"{out_dir}/stops.parquet")
    stoppage = spark.read.parquet(f"{out_dir}/stoppage_stats.parquet")
    lookups = {
        "station_timetable": lambda: L.station_timetable(stops, "Supplier#000000003", period="Evening"),
        "station_card": lambda: L.station_card(stops),
        "train_catalog": lambda: L.train_catalog(stops),
        "train_search_fallback": lambda: L.train_search_fallback(L.train_catalog(stops), "zzz"),
        "route_summary": lambda: L.route_summary(stops),
        "route_endpoints": lambda: L.route_endpoints(stops),
        "route_halt_number": lambda: L.route_halt_number(stops),
        "train_profiles": lambda: L.train_profiles(stops),
        "stoppage_topn": lambda: S.stoppage_topn(stoppage, 25),
    }
    for name, build in lookups.items():
        _, q[f"lookup.{name}"] = timed(lambda: build().write.format("noop").mode("overwrite").save())

    # A second pass (fresh output folder) shows steady-state speed once the
    # JVM has compiled the generated code; the headline value stays the first,
    # cold pass, which is what a one-shot job run costs.
    out2 = f"{root}/out_warm"
    _, warm_clean = timed(lambda: clean_job(spark, raw_dir, out2, stn_dir, trn_dir, RAW_STOPS_JSON))
    _, warm_analyse = timed(lambda: analyse_job(spark, f"{out2}/stops.parquet", out2, f"{out2}/clean_stats.json"))

    total = q["clean_job"] + q["analyse_job"]
    print(json.dumps({
        "metric": "clean_plus_analyse_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": q,
        "sf": _sf(sf_dir),
        "rows": {"raw_rows": stats["raw_rows"], "cleaned_rows": stats["cleaned_rows"]},
        "analyse_seconds": q["analyse_job"],
        "warm": {"clean_job": warm_clean, "analyse_job": warm_analyse,
                 "clean_plus_analyse": round(warm_clean + warm_analyse, 3)},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
