"""Named queries over the driver tables, one per operator.

Each entry is ``(spark, sf_dir) -> DataFrame``: it derives the timetable
inputs from the base tables (:mod:`stopflow.plans.fixture`) and runs the
library operators on them over the whole tables.  Parameters of the
slicers and lookups are fixed here; :mod:`stopflow.plans.oracle` holds the
equivalent SQL.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.functions.text import clean_name
from stopflow.functions.times import minutes_since_midnight, null_placeholder
from stopflow.operators import analytics as A
from stopflow.operators import clean as C
from stopflow.operators import enrich as E
from stopflow.operators import ledger as G
from stopflow.operators import lookup as L
from stopflow.operators import profile as P
from stopflow.operators import quality as Q
from stopflow.operators import slicers as S
from stopflow.operators.conform import conform_stops
from stopflow.plans import fixture as X
from stopflow.schema import RAW_STOPS_JSON, STATIONS_GEOJSON, TRAINS_GEOJSON
from stopflow.session import materialize, scratch_path
from stopflow.sinks import publish as W
from stopflow.sinks import versions as V
from stopflow.sources import files as R
from stopflow.sources.geojson import flatten_feature_collection, to_feature_collections

Query = Callable[[SparkSession, str], DataFrame]


# --- shared building blocks ---------------------------------------------------

def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_stops(X.raw_stops(spark, sf_dir))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.station_dimension(X.station_meta(spark, sf_dir))


def trains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.train_dimension(X.train_meta(spark, sf_dir))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conformed, cleaned, enriched fact table."""
    sm, tm = X.station_meta(spark, sf_dir), X.train_meta(spark, sf_dir)
    return E.enrich(cleaned(spark, sf_dir), E.station_dimension(sm), E.train_dimension(tm),
                    stations_bound=sm, trains_bound=tm)


def _stoppage(spark, d):
    return A.stoppage_stats(stops(spark, d))


def _busiest(spark, d):
    return A.busiest_stations(stops(spark, d), 20)


def _hourly(spark, d):
    return A.hourly_traffic(stops(spark, d))


def _dense(spark, d):
    return A.hourly_traffic_dense(stops(spark, d))


def _catalog(spark, d):
    return L.train_catalog(stops(spark, d))


def _timetable(spark, d, **kw):
    return L.station_timetable(stops(spark, d), "Supplier#000000003", **kw)


# --- scans / sources --------------------------------------------------------------

def scan_parquet(spark, d):
    return R.read_parquet(spark, f"{d.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


def scan_json(spark, d):
    """Raw feed landed as line-delimited JSON in the shared folder, read back with its schema."""
    path = scratch_path(spark, "raw_stops_json")
    X.raw_stops(spark, d).write.mode("overwrite").json(path)
    return R.read_json(spark, path, RAW_STOPS_JSON)


def scan_json_array(spark, d):
    """Raw feed landed as files of one JSON array each, read back with its schema in ranges of 256 KB."""
    def arrays(batches):
        opener = "["
        for b in batches:
            lines = []
            for row in b.column(0).to_pylist():
                lines.append(opener + row)
                opener = ","
            yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["]" if opener == "," else "[]"]})

    path = scratch_path(spark, "raw_stops_json_array")
    X.raw_stops(spark, d).select(F.to_json(F.struct("*"))).mapInArrow(arrays, "value string").write.mode("overwrite").text(path)
    return R.read_json(spark, path, RAW_STOPS_JSON, split_bytes=256 << 10)


def scan_csv(spark, d):
    """Raw feed landed as header CSV, read back all-text (no type inference) in ranges of 256 KB."""
    path = scratch_path(spark, "raw_stops_csv")
    W.export_csv(X.raw_stops(spark, d), path)
    return R.read_csv(spark, path, split_bytes=256 << 10)


# --- cleaning ---------------------------------------------------------------------

def clean_times(spark, d):
    raw = X.raw_stops(spark, d)
    return raw.select("id", null_placeholder("arrival").alias("arrival"), null_placeholder("departure").alias("departure"))


def clean_names(spark, d):
    raw = X.raw_stops(spark, d)
    return raw.select("id", clean_name("trainName").alias("train_name"), clean_name("station").alias("station_code"),
                      clean_name("station_name").alias("station_name"))


def time_to_minutes(spark, d):
    raw = X.raw_stops(spark, d)
    return raw.select("id", *(minutes_since_midnight(F.trim(c)).alias(f"{c}_min") for c in ("arrival", "departure")))


def q_conform_stops(spark, d):
    return conform_stops(X.raw_stops(spark, d))


def drop_missing_keys(spark, d):
    df = C.drop_missing_keys(C.clean_names(conform_stops(X.raw_stops(spark, d))))
    return df.select("train_number", "station_code", F.col("stop_sequence").alias("id"))


def dedup_exact(spark, d):
    return C.dedup_exact(X.raw_stops(spark, d))


def clean_stops(spark, d):
    return cleaned(spark, d)


def stop_duration(spark, d):
    return cleaned(spark, d).select("train_number", "stop_sequence", "arrival", "departure", "stop_duration_mins")


def midnight_crossings(spark, d):
    return C.midnight_crossings(cleaned(spark, d)).select(
        "train_number", "stop_sequence", "station_code", "stop_duration_mins")


def clean_stats(spark, d):
    return C.clean_stats_frame(X.raw_stops(spark, d))


# --- enrichment -------------------------------------------------------------------

def geojson_flatten(spark, d):
    """Station features landed as GeoJSON in the shared folder, read back with their schema."""
    path = scratch_path(spark, "stations_geojson")
    to_feature_collections(X.station_meta(spark, d)).write.mode("overwrite").json(path)
    docs = R.read_feature_collection(spark, path, STATIONS_GEOJSON)
    return flatten_feature_collection(docs, {"code": "code", "state": "state", "zone": "zone"}, "code")


def geojson_trains(spark, d):
    """Train features landed as GeoJSON in the shared folder, read back with their schema."""
    path = scratch_path(spark, "trains_geojson")
    to_feature_collections(X.train_meta(spark, d)).write.mode("overwrite").json(path)
    docs = R.read_feature_collection(spark, path, TRAINS_GEOJSON)
    return flatten_feature_collection(docs, {"number": "number", "type": "type"}, "number")


def dim_dedup(spark, d):
    flat = E.trim_attributes(X.station_meta(spark, d), "code", ["state", "zone"])
    return E.dim_dedup(flat, "code")


def enrich_station(spark, d):
    return E.enrich_station(cleaned(spark, d), stations(spark, d), bound_by=X.station_meta(spark, d)).select(
        "train_number", "stop_sequence", "departure", "state", "zone")


def enrich_train(spark, d):
    return E.enrich_train(cleaned(spark, d), trains(spark, d), bound_by=X.train_meta(spark, d)).select(
        "train_number", "stop_sequence", "departure", "train_type")


def enriched_stops(spark, d):
    return stops(spark, d)


def enrich_unmatched(spark, d):
    flat = E.trim_attributes(X.station_meta(spark, d), "code", ["state", "zone"])
    return E.unmatched_keys(cleaned(spark, d), flat, "station_code", "code")


# --- analytics ----------------------------------------------------------------------

def busiest_search(spark, d):
    return S.busiest_search(_busiest(spark, d), "00[1-4]", 5)


def stoppage_stats(spark, d):
    return _stoppage(spark, d)


def stoppage_filtered(spark, d):
    return S.stoppage_filtered(_stoppage(spark, d), 400, 25.0)


def stoppage_search(spark, d):
    return S.stoppage_search(_stoppage(spark, d), "0001", 50, 10.0)


def stoppage_topn(spark, d):
    return S.stoppage_topn(_stoppage(spark, d), 25, 50, 10.0)


def stoppage_match_counts(spark, d):
    return S.stoppage_match_counts(_stoppage(spark, d), 25, 400, 25.0)


def stoppage_bounds(spark, d):
    return S.stoppage_bounds(_stoppage(spark, d))


def hourly_window(spark, d):
    return S.hour_preset(_hourly(spark, d), "morning")


def hourly_window_overnight(spark, d):
    return S.hour_preset(_hourly(spark, d), "overnight")


def hourly_window_kpis(spark, d):
    """Morning window KPIs over the hourly table (as published, null hour included)."""
    return L.hourly_window_kpis(_hourly(spark, d), 6, 11)


def hourly_peak(spark, d):
    """Peak hour of the default window (all 24 hours)."""
    return L.hourly_peak(S.hour_preset(_hourly(spark, d), "all"))


def hourly_share(spark, d):
    """Labels and shares of the default window (all 24 hours)."""
    return L.hourly_share(S.hour_preset(_hourly(spark, d), "all"))


def longest_trains(spark, d):
    return A.longest_trains(stops(spark, d), 20)


def _breakdown(dim):
    return lambda spark, d: A.breakdown(stops(spark, d), dim)


def breakdown_zone_valid(spark, d):
    return S.valid_categories(A.breakdown(stops(spark, d), "zone"), "zone", 15)


def breakdown_type_valid(spark, d):
    return S.valid_categories(A.breakdown(stops(spark, d), "train_type"), "train_type", 10)


def clean_stops_observed(spark, d):
    """The clean job's path: copy-counted rows, removal counts observed at the end."""
    df, _ = C.finish_counted(C.clean_counted(X.raw_stops(spark, d)))
    return df


def run_summary_from_groups(spark, d):
    """The analyse job's path: summary read off per-station / per-train counts."""
    st = stops(spark, d)
    raw = X.raw_stops(spark, d).agg(F.count(F.lit(1)).alias("raw_rows"))
    return A.summary_from_groups(A.station_traffic(st), A.train_lengths(st), raw)


def breakdown_state_from_counts(spark, d):
    """A breakdown read off per-train category counts (one scan for several outputs)."""
    return A.breakdown_from_counts(A.train_category_counts(stops(spark, d)), "state")


def longest_trains_from_counts(spark, d):
    """Train lengths read off per-train category counts (one scan for several outputs)."""
    lengths = A.lengths_from_counts(A.train_category_counts(stops(spark, d)))
    return A.top_n(lengths, 20, "num_stops", ["train_number", "train_name"])


def run_summary(spark, d):
    raw = X.raw_stops(spark, d).agg(F.count(F.lit(1)).alias("raw_rows"))
    return A.run_summary(stops(spark, d), raw)


# --- lookups -------------------------------------------------------------------------

def distinct_stations(spark, d):
    return L.distinct_values(stops(spark, d), "station_name")


def distinct_train_types(spark, d):
    return L.distinct_values(stops(spark, d), "train_type", drop_blank=True)


def train_search(spark, d):
    return L.train_search(_catalog(spark, d), "110", "2-HIGH")


def train_search_fallback(spark, d):
    return L.train_search_fallback(_catalog(spark, d), "zzz")


def route_itinerary(spark, d):
    return L.route_itinerary(stops(spark, d), "1102")


def route_filtered(spark, d):
    df = S.route_filter(stops(spark, d), ["NATION_1", "NATION_12", "NATION_13"], ["AFRICA", "AMERICA", "ASIA", "EUROPE"], 10)
    return df.select("train_number", "stop_sequence", "state", "zone", "stop_duration_mins")


def route_regions(spark, d):
    return L.route_regions(stops(spark, d), "state")


# --- profiling, quality, publishing ------------------------------------------------------

def profile_nulls(spark, d):
    return P.profile_nulls(X.raw_stops(spark, d))


def profile_schema(spark, d):
    """The per-column inspection report of the raw feed (schema + null-likes, one pass)."""
    return P.profile_columns(X.raw_stops(spark, d))


def profile_datasets(spark, d):
    return P.profile_datasets({"raw_stops": X.raw_stops(spark, d), "station_meta": X.station_meta(spark, d),
                               "train_meta": X.train_meta(spark, d)})


def profile_sample(spark, d):
    raw = X.raw_stops(spark, d)
    return P.profile_sample(raw, 10, ["id", *(c for c in raw.columns if c != "id")])


def dq_report(spark, d):
    """The integrity expectations over the published tables, each read once; stops and removal counts come from one grouping."""
    sm, tm = X.station_meta(spark, d), X.train_meta(spark, d)
    counted = C.clean_counted(X.raw_stops(spark, d))
    groups = materialize(E.enrich(counted, E.station_dimension(sm), E.train_dimension(tm), stations_bound=sm, trains_bound=tm), "dq-stops", "zstd")
    st = groups.filter("_ok").drop("_ok", "_n")
    tables = {"busiest_stations": A.busiest_stations(st, 20), "longest_trains": A.longest_trains(st, 20), "stoppage_stats": A.stoppage_stats(st),
              "hourly_traffic": A.hourly_traffic_dense(st), "breakdown_zone": A.breakdown(st, "zone")}
    tables = {name: materialize(df, f"dq-{name}") for name, df in tables.items()}
    stats = materialize(C.stats_of_groups(groups), "dq-clean-stats")
    summary = materialize(A.run_summary(st, stats), "dq-run-summary")
    top_station = tables["busiest_stations"].orderBy(F.desc("total_stops"), "station_code", "station_name").select("station_name").limit(1).scalar()
    top_train = tables["longest_trains"].orderBy(F.desc("num_stops"), "train_number", "train_name").select("train_number").limit(1).scalar()
    return Q.dq_report(
        Q.stops_checks(st, top_station, top_train),
        Q.positive_counts_check(tables["busiest_stations"], "busiest_stations", ["total_stops", "distinct_trains"]),
        Q.positive_counts_check(tables["longest_trains"], "longest_trains", ["num_stops"]),
        Q.positive_counts_check(tables["stoppage_stats"], "stoppage_stats", ["num_stops"], ["avg_duration_mins", "max_duration_mins", "p90_duration_mins"]),
        Q.positive_counts_check(tables["breakdown_zone"], "breakdown_zone", ["total_stops", "distinct_trains"]),
        Q.hour_domain_check(tables["hourly_traffic"]),
        Q.metrics_check(stats, ["raw_rows", "cleaned_rows"], ["removed_missing", "removed_duplicates"], "clean_stats"),
        Q.metrics_check(summary, ["raw_rows", "cleaned_rows", "distinct_trains", "distinct_stations"], [], "run_summary"),
        *(Q.required_columns_check(df, name) for name, df in {"stops": st, **tables}.items() if name in Q.REQUIRED_COLUMNS),
    )


def name_only_analysis(spark, d):
    """Busiest stations of a feed that has station names but no codes."""
    return A.busiest_stations(C.clean_stops(X.raw_stops(spark, d).drop("station")), 20)


def export_csv(spark, d):
    """The clean dataset exported as header CSV (export column order), read back as text."""
    path = scratch_path(spark, "export_csv")
    W.export_csv(W.export_clean(stops(spark, d)), path)
    return R.read_csv(spark, path)


def clean_stats_json(spark, d):
    """Removal accounting published as a one-row JSON document and read back."""
    path = scratch_path(spark, "clean_stats_json")
    W.write_small(C.clean_stats_frame(X.raw_stops(spark, d)), path, fmt="json")
    return R.read_metrics(spark, path)


def export_clean(spark, d):
    return W.export_clean(stops(spark, d))


def publish_parquet(spark, d):
    """The fact table written in parallel to the shared folder and read back."""
    path = scratch_path(spark, "stops_parquet")
    W.write_table(stops(spark, d), path)
    return spark.read.parquet(path)


def dedup_batches(spark, d):
    """The raw feed in three batches by train, and all of it again, through the ledger of rows seen before."""
    ledger, raw = scratch_path(spark, "row-ledger"), X.raw_stops(spark, d)
    part = F.coalesce(F.pmod(F.xxhash64("number", "id"), F.lit(3)), F.lit(0))
    batches = [raw.filter(part == k) for k in range(3)] + [raw]
    out = None
    for k, batch in enumerate(batches):
        new = G.new_rows(batch, ledger, f"batch-{k}", buckets=8)
        out = new if out is None else out.unionByName(new)
    return out


def publish_versions(spark, d):
    """The raw feed's clean stops published over an earlier version of fewer columns, the current version read back."""
    path = scratch_path(spark, "stops_versions")
    table = materialize(stops(spark, d), "versions-stops", "zstd")  # computed once for both versions
    V.publish_version(table.drop("state", "zone"), path)
    V.publish_version(table, path, cluster_by=["station_name"])
    return V.read_version(spark, path)


QUERIES: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "scan_json": scan_json,
    "scan_json_array": scan_json_array,
    "scan_csv": scan_csv,
    "clean_times": clean_times,
    "clean_names": clean_names,
    "clean_all_names": clean_names,
    "time_to_minutes": time_to_minutes,
    "times_to_minutes": time_to_minutes,
    "conform_stops": q_conform_stops,
    "drop_missing_keys": drop_missing_keys,
    "dedup_exact": dedup_exact,
    "dedup_batches": dedup_batches,
    "clean_stops": clean_stops,
    "clean_stops_observed": clean_stops_observed,
    "stop_duration": stop_duration,
    "midnight_crossings": midnight_crossings,
    "clean_stats": clean_stats,
    "geojson_flatten": geojson_flatten,
    "geojson_trains": geojson_trains,
    "dim_dedup": dim_dedup,
    "enrich_station": enrich_station,
    "enrich_train": enrich_train,
    "enriched_stops": enriched_stops,
    "enrich_unmatched": enrich_unmatched,
    "busiest_stations": _busiest,
    "busiest_search": busiest_search,
    "stoppage_stats": stoppage_stats,
    "stoppage_stats_sql": lambda spark, d: A.stoppage_stats_sql(spark, stops(spark, d)),
    "stoppage_filtered": stoppage_filtered,
    "stoppage_search": stoppage_search,
    "stoppage_topn": stoppage_topn,
    "stoppage_match_counts": stoppage_match_counts,
    "stoppage_bounds": stoppage_bounds,
    "hourly_traffic": _hourly,
    "hourly_traffic_dense": _dense,
    "hourly_window": hourly_window,
    "hourly_window_overnight": hourly_window_overnight,
    "hourly_window_kpis": hourly_window_kpis,
    "hourly_peak": hourly_peak,
    "hourly_share": hourly_share,
    "longest_trains": longest_trains,
    "longest_trains_sql": lambda spark, d: A.longest_trains_sql(spark, stops(spark, d), 20),
    "breakdown_zone": _breakdown("zone"),
    "breakdown_state": _breakdown("state"),
    "breakdown_train_type": _breakdown("train_type"),
    "breakdown_state_from_counts": breakdown_state_from_counts,
    "breakdowns_all": lambda spark, d: A.breakdowns(stops(spark, d)),
    "longest_trains_from_counts": longest_trains_from_counts,
    "breakdown_zone_valid": breakdown_zone_valid,
    "breakdown_type_valid": breakdown_type_valid,
    "run_summary": run_summary,
    "run_summary_from_groups": run_summary_from_groups,
    "distinct_stations": distinct_stations,
    "distinct_train_types": distinct_train_types,
    "station_train_types": lambda spark, d: L.station_train_types(stops(spark, d)),
    "station_profiles": lambda spark, d: L.station_profiles(stops(spark, d)),
    "catalog_train_types": lambda spark, d: L.distinct_values(_catalog(spark, d), "train_type", drop_blank=True),
    "station_timetable": lambda spark, d: _timetable(spark, d),
    "station_timetable_by_type": lambda spark, d: _timetable(spark, d, train_type="2-HIGH"),
    "station_timetable_by_period": lambda spark, d: _timetable(spark, d, period="Evening"),
    "station_timetable_min_halt": lambda spark, d: _timetable(spark, d, min_halt=10),
    "station_card": lambda spark, d: L.station_card(stops(spark, d)),
    "train_catalog": _catalog,
    "train_search": train_search,
    "train_search_fallback": train_search_fallback,
    "route_itinerary": route_itinerary,
    "route_halt_number": lambda spark, d: L.route_halt_number(stops(spark, d)),
    "route_filtered": route_filtered,
    "route_halt_profile": lambda spark, d: L.route_halt_profile(stops(spark, d)),
    "route_summary": lambda spark, d: L.route_summary(stops(spark, d)),
    "route_endpoints": lambda spark, d: L.route_endpoints(stops(spark, d)),
    "route_regions": route_regions,
    "train_profiles": lambda spark, d: L.train_profiles(stops(spark, d)),
    "route_zones": lambda spark, d: L.route_regions(stops(spark, d), "zone"),
    "export_clean": export_clean,
    "export_csv": export_csv,
    "clean_stats_json": clean_stats_json,
    "publish_parquet": publish_parquet,
    "publish_versions": publish_versions,
    "profile_nulls": profile_nulls,
    "profile_schema": profile_schema,
    "profile_datasets": profile_datasets,
    "profile_sample": profile_sample,
    "profile_sample_all": profile_sample,
    "dq_report": dq_report,
    "name_only_analysis": name_only_analysis,
    "station_matches": lambda spark, d: L.station_matches(stops(spark, d), "Supplier#000000003", period="Evening"),
}
