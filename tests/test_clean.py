"""Cleaning: placeholders, key filter, exact dedup, removal accounting."""

from pyspark.sql import functions as F

from stopflow.operators import clean as C
from stopflow.plans import fixture as X
from tests.conftest import SF_SMALL

RAW = [
    # number, trainName, station, station_name, arrival, departure, day, id
    ("101", " Express ", "S1 ", "Alpha", "08:00:00", " 08:10:00", 1, 1),
    ("101", " Express ", "S1 ", "Alpha", "08:00:00", " 08:10:00", 1, 1),   # exact duplicate
    ("101", "None", "S2", "Beta", "23:50:00", "00:05:00", 1, 2),          # crosses midnight
    (None, "X", "S3", "Gamma", "09:00", "09:01", 1, 3),                    # no train
    ("102", "Y", "none", "Delta", "09:00", "09:01", 1, 4),                 # no station
    ("102", "Y", "S4", " ", " NaN ", "", 2, 5),                            # no times
    ("102", "Y", "S5", "Eps", "bad", "10:00", 2, 6),                       # malformed time
]
SCHEMA = "number string, trainName string, station string, station_name string, arrival string, departure string, day int, id long"


def test_clean_stops_rows(spark):
    out = C.clean_stops(spark.createDataFrame(RAW, SCHEMA)).orderBy("stop_sequence").collect()
    assert [r.stop_sequence for r in out] == [1, 2, 5, 6]
    r1, r2, r5, r6 = out
    assert (r1.train_name, r1.station_code, r1.arrival, r1.departure, r1.stop_duration_mins) == ("Express", "S1", "08:00", "08:10", 10)
    assert r2.train_name is None and r2.stop_duration_mins == 15
    assert r5.station_name is None and r5.arrival is None and r5.departure is None and r5.stop_duration_mins is None
    assert r6.arrival == "bad" and r6.stop_duration_mins is None
    assert r1.train_number == "101"


def test_clean_with_stats_matches_frame(spark):
    raw = spark.createDataFrame(RAW, SCHEMA)
    df, stats = C.clean_with_stats(raw)
    n = df.count()
    got = stats.as_dict()
    assert got == {"raw_rows": 7, "cleaned_rows": 4, "removed_missing": 2, "removed_duplicates": 1}
    assert n == 4
    frame = C.clean_stats_frame(raw).first().asDict()
    assert frame == got


def test_accounting_identity_on_fixture(spark):
    """raw = cleaned + removed_missing + removed_duplicates, and the counts of FIXTURES.md."""
    s = C.clean_stats_frame(X.raw_stops(spark, SF_SMALL)).first().asDict()
    assert s == {"raw_rows": 6125, "cleaned_rows": 5902, "removed_missing": 135, "removed_duplicates": 88}
    assert s["raw_rows"] == s["cleaned_rows"] + s["removed_missing"] + s["removed_duplicates"]


def test_dwell_range_property(spark):
    """0 <= dwell <= 1439 for every timed stop of the fixture; midnight crossings counted."""
    stops = C.clean_stops(X.raw_stops(spark, SF_SMALL))
    agg = stops.agg(F.min("stop_duration_mins").alias("lo"), F.max("stop_duration_mins").alias("hi"),
                    F.count("stop_duration_mins").alias("timed"), F.count("arrival").alias("arr")).first()
    assert agg.lo >= 0 and agg.hi <= 1439
    assert (agg.arr, agg.timed) == (4987, 4010)
    assert C.midnight_crossings(stops).count() == 73
