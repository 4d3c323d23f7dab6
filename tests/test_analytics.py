"""Core analytics and their properties on the fixture and on hand-made frames."""

from pyspark.sql import functions as F

from stopflow.operators import analytics as A
from stopflow.plans import queries as Q
from tests.conftest import SF_SMALL


def test_busiest_ties_are_deterministic(spark):
    df = spark.createDataFrame([("t1", "B", "b"), ("t2", "A", "a"), ("t1", "C", "c"), ("t3", "C", "c")],
                               "train_number string, station_code string, station_name string")
    got = [tuple(r) for r in A.busiest_stations(df, 2).collect()]
    assert got == [("C", "c", 2, 2), ("A", "a", 1, 1)]


def test_stoppage_min_stops_floor(spark):
    rows = [("S1", "one", 5)] * 20 + [("S2", "two", 7)] * 19 + [("S1", "one", None)] * 3
    df = spark.createDataFrame(rows, "station_code string, station_name string, stop_duration_mins int")
    got = A.stoppage_stats(df).collect()
    assert len(got) == 1 and got[0].station_code == "S1" and got[0].num_stops == 20
    assert (got[0].avg_duration_mins, got[0].max_duration_mins, got[0].p90_duration_mins) == (5.0, 5, 5)
    sql = A.stoppage_stats_sql(spark, df).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in got]


def test_hourly_properties(spark):
    stops = Q.stops(spark, SF_SMALL)
    hourly = A.hourly_traffic(stops)
    dense = A.hourly_traffic_dense(stops)
    total = hourly.agg(F.sum("arrivals")).first()[0]
    assert total == stops.filter(F.col("arrival").isNotNull()).count()
    assert hourly.count() == 25  # 24 hours + the null hour of malformed arrivals
    d = dense.orderBy("hour").collect()
    assert [r.hour for r in d] == list(range(24)) and all(r.arrivals >= 0 for r in d)
    assert sum(r.arrivals for r in d) == hourly.filter(F.col("hour").isNotNull()).agg(F.sum("arrivals")).first()[0]


def test_breakdowns_sum_to_total(spark):
    stops = Q.stops(spark, SF_SMALL)
    n = stops.count()
    dims = A.breakdown_dimensions(stops.columns)
    assert dims == ["state", "zone", "train_type"]
    for d in dims:
        assert A.breakdown(stops, d).agg(F.sum("total_stops")).first()[0] == n


def test_run_summary(spark):
    stops = Q.stops(spark, SF_SMALL)
    r = A.run_summary(stops, 6125).first()
    assert (r.raw_rows, r.cleaned_rows, r.distinct_stations) == (6125, 5902, 10)
    r2 = A.run_summary(stops).first()
    assert r2.raw_rows == r2.cleaned_rows == 5902


def test_longest_trains_uses_number_when_no_name(spark):
    df = spark.createDataFrame([("1",), ("1",), ("2",)], "train_number string")
    assert [tuple(r) for r in A.longest_trains(df, 5).collect()] == [("1", 2), ("2", 1)]


def test_approximate_distinct_option(spark):
    stops = Q.stops(spark, SF_SMALL)
    exact = {r.station_code: r.distinct_trains for r in A.station_traffic(stops).collect()}
    approx = {r.station_code: r.distinct_trains for r in A.station_traffic(stops, approx_rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(2, 0.08 * v) for k, v in exact.items())
