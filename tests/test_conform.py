"""Alias resolution and required-column checks (plain Python, no Spark job)."""

import pytest

from stopflow.operators import conform as C


def test_first_alias_wins_case_insensitive():
    m = C.resolve_columns(["NUMBER", "trainNo", "Station", "ARR", "dep", "ID", "Seq"])
    assert m["train_number"] == "trainNo"  # trainno precedes number
    assert m["station_code"] == "Station"
    assert m["arrival"] == "ARR" and m["departure"] == "dep"
    assert m["stop_sequence"] == "Seq"  # seq precedes id
    assert "train_name" not in m and "day" not in m


def test_required_missing_raises():
    with pytest.raises(ValueError, match="arrival"):
        C.check_required(C.resolve_columns(["number", "station", "dep"]))


def test_station_name_replaces_code():
    m = C.resolve_columns(["number", "stationName", "arrival", "departure"])
    C.check_required(m)  # no error
    cols = list(m)
    assert C.station_key(cols) == "station_name"
    # when both keys fall back to one column it is grouped once (no duplicate output column)
    assert C.group_keys(C.station_key(cols), C.station_display(cols)) == ["station_name"]


def test_conform_select_and_cast(spark):
    df = spark.createDataFrame([(4601, "x", "S1", "08:00", "08:05", 3)],
                               "trainNumber int, name string, stn_code string, arrival_time string, dep string, serial long")
    out = C.conform_stops(df)
    assert out.columns == ["train_number", "train_name", "station_code", "arrival", "departure", "stop_sequence"]
    assert dict(out.dtypes)["train_number"] == "string"
    assert out.first().train_number == "4601"


def test_csv_text_numbers_are_typed(spark):
    df = spark.createDataFrame([("04601", "S1", "08:00", "08:05", "2", "10"), ("04601", "S2", "09:00", "09:05", "2", "9")],
                               "number string, station string, arrival string, departure string, day string, sno string")
    out = C.conform_stops(df)
    assert dict(out.dtypes) == {"train_number": "string", "station_code": "string", "arrival": "string",
                                "departure": "string", "day": "int", "stop_sequence": "bigint"}
    assert [r.stop_sequence for r in out.orderBy("stop_sequence").collect()] == [9, 10]
    assert out.first().train_number == "04601"
