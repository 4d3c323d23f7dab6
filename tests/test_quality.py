"""Data-quality expectations."""

import pytest

from stopflow.operators import quality as Q


def test_stops_checks_flags_violations(spark):
    df = spark.createDataFrame([("1", "S", "08:00", -5), ("2", None, "bad", 3), ("3", "S", None, None)],
                               "train_number string, station_code string, arrival string, stop_duration_mins int")
    got = {r.check_name: (r.ok, r.violations) for r in Q.stops_checks(df).collect()}
    assert got == {"stops_non_empty": (True, 0), "stop_duration_non_negative": (False, 1),
                   "stop_duration_present": (True, 0), "keys_not_null": (False, 1), "arrival_hour_in_0_23": (False, 1)}


def test_result_table_checks(spark):
    busiest = spark.createDataFrame([("S", "s", 3, 1), ("T", "t", 0, 1)],
                                    "station_code string, station_name string, total_stops long, distinct_trains long")
    assert Q.missing_columns(busiest, "busiest_stations") == []
    got = {r.check_name: r.ok for r in Q.positive_counts_check(busiest, "busiest", ["total_stops", "distinct_trains"]).collect()}
    assert got == {"busiest_non_empty": True, "busiest_counts_positive": False}
    dense = spark.range(24).selectExpr("CAST(id AS INT) AS hour", "1L AS arrivals")
    assert Q.hour_domain_check(dense).first().ok
    assert not Q.hour_domain_check(dense.filter("hour < 23")).first().ok
    metrics = spark.createDataFrame([(10, 8, 1, 1)], "raw_rows long, cleaned_rows long, removed_missing long, removed_duplicates long")
    assert Q.metrics_check(metrics, ["raw_rows", "cleaned_rows"], ["removed_missing", "removed_duplicates"], "clean_stats").first().ok
    with pytest.raises(ValueError):
        Q.metrics_check(metrics, ["distinct_trains"], [], "run_summary")
