"""File sources written by the test itself: JSON array, NDJSON, CSV, GeoJSON, manifests."""

import json
import os

import pytest

from stopflow.operators import enrich as E
from stopflow.schema import RAW_STOPS_JSON, STATIONS_GEOJSON, TRAINS_GEOJSON
from stopflow.sources import files as R

STOPS = [{"number": f"0460{i}", "trainName": "Exp", "station": f"S{i}", "station_name": f"N{i}",
          "arrival": "23:45:00", "departure": "00:10:00", "day": 1, "id": i} for i in range(10)]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_json_array_and_ndjson(spark, tmp_dir):
    arr = _write(os.path.join(tmp_dir, "stops_array.json"), json.dumps(STOPS, indent=2))
    nd = _write(os.path.join(tmp_dir, "stops.ndjson"), "\n".join(json.dumps(s) for s in STOPS))
    assert R.is_json_array(spark, arr) and not R.is_json_array(spark, nd)
    a = R.read_json(spark, arr, RAW_STOPS_JSON)
    b = R.read_json(spark, nd, RAW_STOPS_JSON)
    assert a.count() == b.count() == 10
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.filter("number = '04600'").count() == 1  # text kept, leading zero intact


def test_csv_reads_text(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "stops.csv"),
               "number,station,arrival,departure\n04601,S1,23:45:00,00:15:00\n04602,S2,,08:00\n")
    df = R.read_csv(spark, p)
    assert dict(df.dtypes) == {"number": "string", "station": "string", "arrival": "string", "departure": "string"}
    rows = df.orderBy("number").collect()
    assert rows[0].number == "04601" and rows[0].arrival == "23:45:00" and rows[1].arrival is None


def test_read_any_dispatch(spark, tmp_dir):
    with pytest.raises(ValueError, match="unsupported"):
        R.read_any(spark, os.path.join(tmp_dir, "x.xlsx"))
    p = os.path.join(tmp_dir, "t.parquet")
    spark.range(5).write.parquet(p)
    assert R.read_any(spark, p).count() == 5


def test_geojson_files(spark, tmp_dir):
    stations = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"code": " S1 ", "state": "A", "zone": "Z1"}},
        {"type": "Feature", "properties": {"code": "  ", "state": "B", "zone": "Z2"}},
        {"type": "Feature", "properties": None},
        {"type": "Feature", "properties": {"code": "S1", "state": "C", "zone": "Z0"}},
    ]}
    trains = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"number": 4601, "type": "Exp"}},
        {"type": "Feature", "properties": {"number": 4602, "type": None}},
    ]}
    sp = _write(os.path.join(tmp_dir, "stations.geojson"), json.dumps(stations, indent=2))
    tp = _write(os.path.join(tmp_dir, "trains.geojson"), json.dumps(trains))
    st = E.station_dimension_from_geojson(R.read_feature_collection(spark, sp, STATIONS_GEOJSON)).collect()
    assert [tuple(r) for r in st] == [("S1", "A", "Z0")]
    tr = E.train_dimension_from_geojson(R.read_feature_collection(spark, tp, TRAINS_GEOJSON)).orderBy("_train_key").collect()
    assert [tuple(r) for r in tr] == [("4601", "Exp"), ("4602", None)]


def test_file_manifest(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "big.json"), "x" * 500)
    _write(os.path.join(tmp_dir, "small.json"), "x" * 5)
    rows = R.file_manifest(spark, tmp_dir).collect()
    assert [r.name for r in rows] == ["big.json", "small.json"]
    assert rows[0].length == 500


def test_largest_file(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "schedules.json"), "x" * 900)
    _write(os.path.join(tmp_dir, "stations.json"), "x" * 5000)
    _write(os.path.join(tmp_dir, "notes.txt"), "x" * 9000)
    assert R.largest_file(spark, tmp_dir).endswith("stations.json")
    assert R.largest_file(spark, tmp_dir, exclude=("stations.json",)).endswith("schedules.json")
    with pytest.raises(ValueError):
        R.largest_file(spark, tmp_dir, extensions=(".parquet",))
