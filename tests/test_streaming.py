"""Streaming ingest over files the test lands itself."""

import json
import os

from stopflow.operators import enrich as E
from stopflow.streaming.ingest import start_clean_stream


def test_available_now_ingest(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    rows = [{"number": "7", "trainName": " T ", "station": "S1 ", "station_name": "One", "arrival": "23:50:00",
             "departure": "00:10:00", "day": 1, "id": i} for i in range(5)]
    rows.append({"number": None, "station": "S1", "arrival": "x", "departure": "y", "id": 99})
    rows.append(dict(rows[0]))  # exact duplicate in the same file
    with open(os.path.join(landing, "part-0.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    stations = E.station_dimension(spark.createDataFrame([("S1", "St", "Zn")], "code string, state string, zone string"))
    out = os.path.join(tmp_dir, "stops")
    q = start_clean_stream(spark, landing, out, stations=stations, checkpoint=os.path.join(tmp_dir, "ckpt"),
                           available_now=True)
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert "batch" in df.columns
    got = df.collect()
    assert len(got) == 5
    assert {r.stop_duration_mins for r in got} == {20}
    assert {(r.state, r.zone, r.train_name) for r in got} == {("St", "Zn", "T")}


def test_restart_resumes_from_checkpoint(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "stops", "ckpt"))
    os.makedirs(landing)

    def land(name, first_id):
        rows = [{"number": "9", "trainName": "T", "station": "S1", "station_name": "One", "arrival": "10:00",
                 "departure": "10:05", "day": 1, "id": first_id + i} for i in range(3)]
        with open(os.path.join(landing, name), "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows))

    land("a.json", 0)
    start_clean_stream(spark, landing, out, checkpoint=ckpt, available_now=True).awaitTermination(120)
    land("b.json", 100)
    start_clean_stream(spark, landing, out, checkpoint=ckpt, available_now=True).awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted(r.stop_sequence for r in got.collect()) == [0, 1, 2, 100, 101, 102]
    assert got.select("batch").distinct().count() == 2  # the second run only read the new file


def test_duplicates_across_runs_are_dropped(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "stops", "ckpt"))
    os.makedirs(landing)
    row = {"number": "5", "trainName": "T", "station": "S1", "station_name": "One", "arrival": "10:00",
           "departure": "10:05", "day": 1, "id": 1}
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write(json.dumps(row))
    start_clean_stream(spark, landing, out, checkpoint=ckpt, available_now=True).awaitTermination(120)
    with open(os.path.join(landing, "b.json"), "w") as fh:  # the same stop again, plus a new one
        fh.write(json.dumps(row) + "\n" + json.dumps(dict(row, id=2)))
    start_clean_stream(spark, landing, out, checkpoint=ckpt, available_now=True).awaitTermination(120)
    assert sorted(r.stop_sequence for r in spark.read.parquet(out).collect()) == [1, 2]
