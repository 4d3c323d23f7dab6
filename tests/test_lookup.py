"""Explorer lookups and slicers."""

from pyspark.sql import functions as F

from stopflow.operators import lookup as L
from stopflow.operators import slicers as S

STOPS = [
    # train_number, train_name, train_type, station_code, station_name, arrival, departure, day, stop_sequence, dur, state, zone
    ("11", "Alpha", "EXP", "S2", "Two", "08:10", "08:15", 1, 2, 5, "A", "Z1"),
    ("11", "Alpha", "EXP", "S1", "One", None, "08:00", 1, 1, None, "B", "Z1"),
    ("11", "Alpha", "EXP", "S3", "Three", "20:00", None, 2, 3, None, None, ""),
    ("22", None, "", "S1", "One", "09:00", "09:30", None, 5, 30, "B", "Z1"),
    ("33", "Beta", None, "S2", "Two", "19:00", "19:02", 1, 1, 2, "A", "?"),
]
SCHEMA = ("train_number string, train_name string, train_type string, station_code string, station_name string, "
          "arrival string, departure string, day int, stop_sequence long, stop_duration_mins int, state string, zone string")


def _df(spark):
    return spark.createDataFrame(STOPS, SCHEMA)


def test_train_catalog_and_labels(spark):
    cat = {r.train_number: r for r in L.train_catalog(_df(spark)).collect()}
    assert cat["11"].label == "11 — Alpha (EXP)"
    assert cat["22"].label == "22 — None (Rail)"
    assert cat["33"].label == "33 — Beta (Rail)"


def test_search_regex_literal_and_fallback(spark):
    cat = L.train_catalog(_df(spark))
    assert {r.train_number for r in L.train_search(cat, "^1").collect()} == {"11"}
    assert L.train_search(cat, "a.p", literal=True).count() == 0
    assert {r.train_number for r in L.train_search(cat, "a.p").collect()} == {"11"}
    assert L.train_search_fallback(cat, "zzz").count() == 3
    assert L.train_search_fallback(cat, "beta").count() == 1
    assert L.train_search(cat, None, "EXP").count() == 1


def test_route_summary_endpoints_regions(spark):
    df = _df(spark)
    s = {r.train_number: r for r in L.route_summary(df).collect()}
    assert (s["11"].total_halts, s["11"].journey_days, s["11"].states, s["11"].zones) == (3, 2, 2, 2)
    assert s["22"].journey_days == 1
    e = {r.train_number: r for r in L.route_endpoints(df).collect()}
    assert (e["11"].origin, e["11"].destination) == ("One (S1)", "Three (S3)")
    g = {r.train_number: r.states for r in L.route_regions(df).collect()}
    assert g["11"] == "A,B"


def test_station_timetable_slicers(spark):
    df = _df(spark)
    assert [r.train_number for r in L.station_timetable(df, "Two").collect()] == ["11", "33"]
    assert [r.train_number for r in L.station_timetable(df, "Two", period="Evening").collect()] == ["33"]
    assert [r.train_number for r in L.station_timetable(df, "Two", min_halt=3).collect()] == ["11"]
    assert L.station_timetable(df, "One").collect()[-1].arrival is None  # nulls last
    card = {r.station_name: r for r in L.station_card(df).collect()}
    assert (card["One"].services, card["One"].avg_halt_mins) == (2, 30.0)


def test_halt_numbers(spark):
    got = {(r.train_number, r.stop_sequence): r.halt_no for r in L.route_halt_number(_df(spark)).collect()}
    assert got[("11", 1)] == 1 and got[("11", 3)] == 3 and got[("22", 5)] == 1


def test_hourly_kpis(spark):
    hourly = spark.createDataFrame([(h, 10 if h == 7 else 1) for h in range(24)], "hour int, arrivals long")
    k = L.hourly_window_kpis(hourly, 6, 11).first()
    assert (k.window_total, k.hour_bins) == (15, 6) and abs(k.window_pct - 100.0 * 15 / 33) < 1e-9
    assert tuple(L.hourly_peak(hourly).first()) == (7, 10)
    share = L.hourly_share(S.hour_window(hourly, 22, 5)).collect()
    assert len(share) == 8 and abs(sum(r.pct for r in share) - 100.0) < 1e-9


def test_valid_categories_and_filters(spark):
    bd = spark.createDataFrame([("Z1", 5, 2), ("?", 9, 1), ("", 9, 1), (None, 9, 1)], "zone string, total_stops long, distinct_trains long")
    assert [r.zone for r in S.valid_categories(bd, "zone", 15).collect()] == ["Z1"]
    df = _df(spark)
    assert S.route_filter(df, ["A"], [], 0).count() == 2
    assert S.route_filter(df, None, None, 3).count() == 2
    stats = spark.createDataFrame([("S1", "One", 60, 12.0), ("S2", "Two", 40, 30.0)],
                                  "station_code string, station_name string, num_stops long, avg_duration_mins double")
    assert S.stoppage_filtered(stats).count() == 1
    b = S.stoppage_bounds(stats).first()
    assert (b.max_num_stops, b.max_avg, b.slider_max) == (60, 30.0, 30.0)
    m = S.stoppage_match_counts(stats, 1, 20, 1.0).first()
    assert (m.matched, m.displayed) == (2, 1)
    assert F is not None


def test_label_round_trip(spark):
    from stopflow.functions.text import label_number, train_label
    df = spark.createDataFrame([("12345", "Night Mail", None), ("7", None, "")], "n string, m string, t string")
    got = df.select(train_label("n", "m", "t").alias("l")).select("l", label_number("l").alias("back")).collect()
    assert [tuple(r) for r in got] == [("12345 — Night Mail (Rail)", "12345"), ("7 — None (Rail)", "7")]
