"""End-to-end jobs on files, then the reference's artifact-integrity checks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from stopflow.operators import analytics as A
from stopflow.operators import quality as Q
from stopflow.plans import fixture as X
from stopflow.plans.jobs import analyse_job, clean_job, inspect_job
from stopflow.schema import RAW_STOPS_JSON
from stopflow.sources.geojson import to_feature_collections
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    raw, stn, trn, out = (os.path.join(root, n) for n in ("raw", "stations", "trains", "out"))
    X.raw_stops(spark, SF_SMALL).write.json(raw)
    to_feature_collections(X.station_meta(spark, SF_SMALL)).write.json(stn)
    to_feature_collections(X.train_meta(spark, SF_SMALL)).write.json(trn)
    stats = clean_job(spark, raw, out, stn, trn, RAW_STOPS_JSON)
    summary = analyse_job(spark, os.path.join(out, "stops.parquet"), out, os.path.join(out, "clean_stats.json"))
    return out, stats, summary


def test_clean_stats(published):
    _, stats, _ = published
    assert stats == {"raw_rows": 6125, "cleaned_rows": 5902, "removed_missing": 135, "removed_duplicates": 88}


def test_run_summary(spark, published):
    out, _, summary = published
    assert summary["raw_rows"] == 6125 and summary["cleaned_rows"] == 5902
    assert summary["distinct_stations"] == 10 and summary["pipeline_runtime_seconds"] > 0
    doc = spark.read.json(os.path.join(out, "run_summary.json"))
    ok = Q.metrics_check(doc, ["raw_rows", "cleaned_rows", "distinct_trains", "distinct_stations",
                               "pipeline_runtime_seconds"], [], "run_summary").first().ok
    assert ok
    cs = spark.read.json(os.path.join(out, "clean_stats.json"))
    assert Q.metrics_check(cs, ["raw_rows", "cleaned_rows"], ["removed_missing", "removed_duplicates"], "clean_stats").first().ok


def test_published_tables(spark, published):
    out = published[0]
    read = lambda n: spark.read.parquet(os.path.join(out, f"{n}.parquet"))
    busiest = read("busiest_stations")
    assert Q.missing_columns(busiest, "busiest_stations") == [] and busiest.count() == 10
    assert all(r.ok for r in Q.positive_counts_check(busiest, "busiest", ["total_stops", "distinct_trains"]).collect())
    stoppage = read("stoppage_stats")
    assert stoppage.filter((F.col("avg_duration_mins") < 0) | (F.col("p90_duration_mins") < 0)).count() == 0
    longest = read("longest_trains")
    assert longest.count() == 20 and longest.filter("num_stops <= 0").count() == 0
    hourly = read("hourly_traffic")
    assert hourly.count() == 25
    stops_all = read("stops")
    for d in ("zone", "state", "train_type"):
        got = sorted((tuple(r) for r in read(f"breakdown_{d}").collect()), key=repr)
        direct = sorted((tuple(r) for r in A.breakdown(stops_all, d).collect()), key=repr)
        assert got == direct
    stops = read("stops")
    assert all(r.ok for r in Q.stops_checks(stops).collect() if r.check_name != "arrival_hour_in_0_23")
    top = busiest.orderBy(F.desc("total_stops"), "station_code").first()
    assert all(r.ok for r in Q.lookup_check(stops, "station_name", top.station_name, "1").collect())


def test_inspect_job(spark, tmp_dir):
    p = os.path.join(tmp_dir, "stops.json")
    with open(p, "w") as fh:
        json.dump([{"a": "None", "b": 1}, {"a": "", "b": None}, {"a": "x", "b": 2}], fh, indent=1)
    skip = os.path.join(tmp_dir, "notes.txt")
    open(skip, "w").write("hello")
    ins = inspect_job(spark, [p, skip])
    assert ins.skipped == ["notes.txt"]
    nulls = {r.column_name: (r.nulls, r.pct) for r in ins.nulls["stops.json"].collect()}
    assert nulls == {"a": (2, 66.7), "b": (1, 33.3)}
    assert [tuple(r) for r in ins.summary.collect()] == [("stops.json", 3, 2)]
    assert {r.column_name for r in ins.schemas["stops.json"].collect()} == {"a", "b"}


def test_missing_input_raises(spark, tmp_dir):
    with pytest.raises(ValueError):
        clean_job(spark, os.path.join(tmp_dir, "nope.json"), tmp_dir)
    with pytest.raises(ValueError):
        analyse_job(spark, os.path.join(tmp_dir, "nope.parquet"), tmp_dir)


def test_clean_job_other_naming_inferred(spark, tmp_dir):
    """A feed with different column names (resolved by aliases), read by inference."""
    rows = [{"train_no": "0042", "trainName": "A", "stationCode": "X1", "stationName": "Ex",
             "arrival_time": "10:00:00", "departure_time": "10:07:00", "seq": 1},
            {"train_no": "0042", "trainName": "A", "stationCode": "none", "stationName": "Ex",
             "arrival_time": "11:00", "departure_time": "11:02", "seq": 2}]
    raw = os.path.join(tmp_dir, "feed.json")
    with open(raw, "w") as fh:
        json.dump(rows, fh, indent=1)
    out = os.path.join(tmp_dir, "out")
    stats = clean_job(spark, raw, out)
    assert stats == {"raw_rows": 2, "cleaned_rows": 1, "removed_missing": 1, "removed_duplicates": 0}
    got = spark.read.parquet(os.path.join(out, "stops.parquet")).first()
    assert (got.train_number, got.station_code, got.stop_duration_mins, got.stop_sequence) == ("0042", "X1", 7, 1)
