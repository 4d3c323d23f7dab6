"""The jobs a user runs: inspect, clean, analyse.

* **inspect** - profile every raw input: schema, rows/columns, null-like
  values per column, a sample; one summary table across inputs.
* **clean** - raw feed -> conformed, cleaned, de-duplicated, enriched
  ``stops`` table (Parquet) plus removal statistics.  The statistics ride
  on the write via ``observe`` in its final stage: one pass over the data,
  exact even when stages are re-run.
* **analyse** - the published analytics tables over ``stops`` plus a run
  summary.

Inputs are paths; outputs go below ``out_dir`` (a shared folder on a
cluster).  Missing inputs raise ``ValueError`` before any Spark job.
"""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopflow.operators import analytics as A
from stopflow.operators import clean as C
from stopflow.operators import enrich as E
from stopflow.operators import profile as P
from stopflow.operators.conform import station_display, station_key
from stopflow.schema import STATIONS_GEOJSON, TRAINS_GEOJSON
from stopflow.sinks import publish as W
from stopflow.sinks import versions as V
from stopflow.sources import files as R
from stopflow.sources.paths import exists


def _require(spark: SparkSession, path: str, what: str) -> None:
    if not exists(spark, path):
        raise ValueError(f"{what} not found at {path}")


# --- inspect ----------------------------------------------------------------------

@dataclass
class Inspection:
    schemas: dict[str, DataFrame] = field(default_factory=dict)
    nulls: dict[str, DataFrame] = field(default_factory=dict)
    samples: dict[str, DataFrame] = field(default_factory=dict)
    summary: DataFrame | None = None
    skipped: list[str] = field(default_factory=list)


def input_names(paths: list[str]) -> dict[str, str]:
    """A name for each input: its last part, or the whole path where inputs share a last part."""
    last = {p: os.path.basename(p.rstrip("/")) for p in paths}
    return {p: p.rstrip("/") if list(last.values()).count(n) > 1 else n for p, n in last.items()}


def inspect_job(spark: SparkSession, paths: list[str]) -> Inspection:
    """Profile each input; unsupported formats are listed in ``skipped``, a missing path raises ``ValueError``."""
    out = Inspection()
    names = input_names(paths)
    for p in names:
        _require(spark, p, "input")
    rows = []
    for p, name in names.items():
        try:
            df = R.read_any(spark, p)
        except ValueError:
            out.skipped.append(name)
            continue
        out.schemas[name] = P.profile_schema(spark, df, name)
        out.nulls[name] = P.profile_nulls(df)
        out.samples[name] = P.profile_sample(df, 10)
        rows.append(P.profile_datasets({name: df}))
    for r in rows:
        out.summary = r if out.summary is None else out.summary.unionByName(r)
    return out


# --- clean ------------------------------------------------------------------------

def load_raw(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The raw feed by extension (a folder without extension is JSON).

    With ``schema`` (e.g. :data:`stopflow.schema.RAW_STOPS_JSON`) there is no
    inference pass; without it JSON columns are inferred from the whole input,
    and CSV is read as text.
    """
    return R.read_any(spark, path, schema)


def clean_job(spark: SparkSession, raw_path: str, out_dir: str, stations_path: str | None = None,
              trains_path: str | None = None, raw_schema: T.StructType | None = None, versioned: bool = False) -> dict:
    """Clean the raw feed, enrich it, publish ``stops.parquet`` and ``clean_stats.json``.

    With ``versioned`` the stops are published as the next version of a table
    (:mod:`stopflow.sinks.versions`), so a run that ends early leaves the one
    before readable; the analyse job reads either form.
    Give ``raw_schema`` to skip JSON schema inference.  A path that is given
    must exist; records that can't be parsed fail the job.
    """
    _require(spark, raw_path, "raw schedule feed")
    raw = load_raw(spark, raw_path, raw_schema)
    for path, what in ((stations_path, "station attributes"), (trains_path, "train attributes")):
        if path:
            _require(spark, path, what)
    counted = C.clean_counted(raw)
    stations = trains = st_bound = tr_bound = None
    if stations_path:
        fc = R.read_feature_collection(spark, stations_path, STATIONS_GEOJSON)
        stations, st_bound = E.station_dimension_from_geojson(fc), fc.select(F.explode("features"))
    if trains_path:
        fc = R.read_feature_collection(spark, trains_path, TRAINS_GEOJSON)
        trains, tr_bound = E.train_dimension_from_geojson(fc), fc.select(F.explode("features"))
    enriched = E.enrich(counted, stations, trains, stations_bound=st_bound, trains_bound=tr_bound)
    stops, stats = C.finish_counted(enriched)
    # Lookups filter the published table by station name and by train number:
    # cluster each file by station, bloom-filter the equality keys.
    cluster = [c for c in ("station_name", "train_number") if c in stops.columns]
    blooms = [c for c in ("train_number", "station_code") if c in stops.columns]
    if versioned:
        V.publish_version(stops, f"{out_dir}/stops.parquet", cluster_by=cluster, bloom_filter_columns=blooms)
    else:
        W.write_table(stops, f"{out_dir}/stops.parquet", cluster_by=cluster, bloom_filter_columns=blooms)
    metrics = stats.as_dict()
    W.write_metrics(spark, metrics, f"{out_dir}/clean_stats.json")
    return metrics


# --- analyse ----------------------------------------------------------------------

CLEAN_STATS_SCHEMA = "raw_rows long, cleaned_rows long, removed_missing long, removed_duplicates long"


def analyse_job(spark: SparkSession, stops_path: str, out_dir: str, clean_stats_path: str | None = None,
                timings: dict | None = None, parallel_jobs: int = 4) -> dict:
    """Publish busiest stations, dwell statistics, hourly traffic, longest
    trains, one breakdown per dimension column, and the run summary.

    Per-station and per-train counts are aggregated once and written next
    to the outputs (``_station_traffic``, ``_train_lengths``); the top-N
    lists and the run summary are read off those small tables instead of
    scanning the stops again.  Each breakdown reads two narrow columns
    (its dimension and the train number).  Independent outputs are
    submitted as concurrent Spark jobs so short stages of one overlap.
    Dwell statistics have a row per station, so they are sorted and written
    by all tasks.
    """
    _require(spark, stops_path, "stops table")
    start = time.time()
    stops = V.read_version(spark, stops_path) if V.versions(spark, stops_path) else spark.read.parquet(stops_path)
    timings = {} if timings is None else timings

    def timed(name: str, fn) -> None:
        t0 = time.time()
        fn()
        timings[name] = round(time.time() - t0, 3)

    def publish(name: str, df: DataFrame) -> None:
        timed(name, lambda: W.write_small(df, f"{out_dir}/{name}.parquet"))

    station_keys = A.group_keys(station_key(stops.columns), station_display(stops.columns))
    station_path, train_path = f"{out_dir}/_station_traffic.parquet", f"{out_dir}/_train_lengths.parquet"
    base_jobs = {
        "_station_traffic": lambda: timed("_station_traffic", lambda: W.write_table(A.station_traffic(stops), station_path)),
        "_train_lengths": lambda: timed("_train_lengths", lambda: W.write_table(A.train_lengths(stops), train_path)),
        "stoppage_stats": lambda: timed("stoppage_stats", lambda: W.write_table(
            A.stoppage_stats(stops).orderBy(F.col("avg_duration_mins").desc(), *station_keys), f"{out_dir}/stoppage_stats.parquet")),
        "hourly_traffic": lambda: publish("hourly_traffic", A.hourly_traffic(stops).orderBy("hour")),
    }
    for dim in A.breakdown_dimensions(stops.columns):
        base_jobs[f"breakdown_{dim}"] = (lambda d: lambda: publish(
            f"breakdown_{d}", A.breakdown(stops, d).orderBy(F.col("total_stops").desc(), d)))(dim)
    _run_concurrently(base_jobs, parallel_jobs)

    station = spark.read.parquet(station_path)
    trains = spark.read.parquet(train_path)
    key = [c for c in station.columns if c not in ("total_stops", "distinct_trains")]
    tkey = [c for c in trains.columns if c != "num_stops"]
    _run_concurrently({
        "busiest_stations": lambda: publish("busiest_stations", A.top_n(station, 20, "total_stops", key)),
        "longest_trains": lambda: publish("longest_trains", A.top_n(trains, 20, "num_stops", tkey)),
    }, parallel_jobs)
    elapsed = round(time.time() - start, 1)

    t0 = time.time()
    raw_rows = None
    if clean_stats_path and exists(spark, clean_stats_path):
        raw_rows = spark.read.schema(CLEAN_STATS_SCHEMA).json(clean_stats_path)
    row = A.summary_from_groups(station, trains, raw_rows).first().asDict()
    row["pipeline_runtime_seconds"] = elapsed
    W.write_metrics(spark, row, f"{out_dir}/run_summary.json")
    timings["run_summary"] = round(time.time() - t0, 3)
    return row


def _run_concurrently(jobs: dict, workers: int) -> None:
    """Run independent driver-side actions on a thread pool; re-raise the first failure."""
    if workers <= 1:
        for fn in jobs.values():
            fn()
        return
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [pool.submit(fn) for fn in jobs.values()]
        for f in futures:
            f.result()
