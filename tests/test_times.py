"""Clock-time functions: the reference's unit vectors, run on the real Spark expressions."""

import pytest
from pyspark.sql import functions as F

from stopflow.functions import times as T

DURATION_VECTORS = [
    ("08:00", "08:20", 20),
    ("10:15", "11:30", 75),
    ("12:00", "12:00", 0),
    ("23:45", "00:15", 30),
    ("23:55", "00:05", 10),
    ("22:30", "01:15", 165),
    ("08:00:00", "08:20:00", 20),
    (None, "08:20", None),
    ("08:00", None, None),
    (None, None, None),
    # malformed text never raises under ANSI mode: it is null
    ("abc", "08:00", None),
    ("8", "08:00", None),
    ("aa:bb", "08:00", None),
    # hours are not range-checked: 24:10 -> 00:05 gives -5
    ("24:10", "00:05", -5),
]


def test_dwell_vectors(spark):
    df = spark.createDataFrame(DURATION_VECTORS, "a string, d string, expected int")
    got = df.select(T.dwell_minutes("a", "d").alias("m"), "expected").collect()
    assert [r.m for r in got] == [r.expected for r in got]


PLACEHOLDER_VECTORS = [
    ("", None), ("   ", None), (None, None), ("none", None), ("NONE", None), ("None", None),
    ("nan", None), ("NaN", None), ("null", None), ("NULL", None),
    ("08:00", "08:00"), (" 14:30 ", "14:30"), ("00:15:00", "00:15:00"), ("23:59", "23:59"),
    ("\t08:00", "\t08:00"),  # trim strips spaces only
]


def test_time_placeholders(spark):
    df = spark.createDataFrame(PLACEHOLDER_VECTORS, "t string, expected string")
    got = df.select(T.null_placeholder("t").alias("v"), "expected").collect()
    assert [r.v for r in got] == [r.expected for r in got]


def test_parse_parts(spark):
    df = spark.createDataFrame([("08:05:00",), ("8",), ("x:1",), (None,), ("8.5:10",)], "t string")
    got = df.select(T.hour_of("t").alias("h"), T.minutes_since_midnight("t").alias("m"), T.hh_mm("t").alias("s")).collect()
    assert [(r.h, r.m, r.s) for r in got] == [(8, 485, "08:05"), (8, None, "8"), (None, None, "x:1"),
                                              (None, None, None), (8, 490, "8.5:1")]


def test_fraction_truncates_like_the_original_cast(spark):
    df = spark.createDataFrame([(" 8.9 ",), ("-3.2",), ("1e2",), ("8.5x",), ("99999999999.5",), ("7",)], "t string")
    got = [r[0] for r in df.select(T.to_int_truncating(df.t)).collect()]
    assert got == [8, -3, None, None, None, 7]


def test_hour_label_and_window(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    labels = [r[0] for r in df.select(T.hour_label("hour")).collect()]
    assert labels[0] == "00:00" and labels[23] == "23:00"
    inside = [r.hour for r in df.filter(T.in_hour_window("hour", 22, 5)).collect()]
    assert inside == [0, 1, 2, 3, 4, 5, 22, 23]
    assert df.filter(T.in_hour_window("hour", 6, 11)).count() == 6


@pytest.mark.parametrize("period,expected", [
    ("Morning (06:00-12:00)", ["06:00", "11:59"]),
    ("Afternoon", ["12:00"]),
    ("Evening", ["18:30", "23:10"]),
    ("Night", ["00:10", "05:59"]),
    ("All Day", ["00:10", "05:59", "06:00", "11:59", "12:00", "18:30", "23:10", "bad", None]),
])
def test_arrival_periods(spark, period, expected):
    rows = [("00:10",), ("05:59",), ("06:00",), ("11:59",), ("12:00",), ("18:30",), ("23:10",), ("bad",), (None,)]
    df = spark.createDataFrame(rows, "arrival string")
    got = [r.arrival for r in df.filter(T.in_arrival_period("arrival", period)).collect()]
    assert got == expected


def test_unknown_period_rejected():
    with pytest.raises(ValueError):
        T.in_arrival_period("arrival", "Lunch")


def test_strict_range_check(spark):
    df = spark.createDataFrame([("24:10", "00:05"), ("08:61", "09:00"), ("08:00", "08:30")], "a string, d string")
    got = [r[0] for r in df.select(T.dwell_minutes("a", "d", strict=True)).collect()]
    assert got == [None, None, 30]
