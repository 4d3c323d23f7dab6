"""A minimal feed: only train, station name, arrival, departure (no code, day,
sequence or attributes).  Every analysis and lookup still runs, as the
optional columns simply do not exist downstream."""

from stopflow.operators import analytics as A
from stopflow.operators import clean as C
from stopflow.operators import enrich as E
from stopflow.operators import lookup as L
from stopflow.operators import quality as Q
from stopflow.operators import slicers as S

ROWS = [(str(t), f"Stn{s}", f"{s % 24:02d}:{t:02d}", f"{s % 24:02d}:{t + 5:02d}") for t in range(3) for s in range(25)]


def test_minimal_feed_end_to_end(spark):
    raw = spark.createDataFrame(ROWS, "train_no string, stationName string, arr string, dep string")
    stops = C.clean_stops(raw)
    assert set(stops.columns) == {"train_number", "station_name", "arrival", "departure", "stop_duration_mins"}
    st = E.station_dimension(spark.createDataFrame([("X", "s", "z")], "code string, state string, zone string"))
    stops = E.enrich(stops, st, None)  # no station codes: enrichment is skipped
    assert "state" not in stops.columns
    assert A.busiest_stations(stops).columns == ["station_name", "total_stops", "distinct_trains"]
    assert A.stoppage_stats(stops).count() == 0  # 3 timed stops per station < 20
    assert A.hourly_traffic(stops).count() == 24
    assert A.longest_trains(stops).first().num_stops == 25
    assert A.breakdown_dimensions(stops.columns) == []
    assert A.run_summary(stops).first().distinct_stations == 25
    assert L.station_card(stops).filter("station_name = 'Stn0'").first().services == 3
    cat = L.train_catalog(stops)
    assert cat.count() == 3 and cat.first().label.endswith("(Rail)")
    summ = {r.train_number: r for r in L.route_summary(stops).collect()}
    assert (summ["1"].total_halts, summ["1"].journey_days, summ["1"].states) == (25, 1, 0)
    assert L.route_endpoints(stops).count() == 3
    assert L.route_itinerary(stops, "1").count() == 25
    assert L.route_itinerary(stops, "1", states=["North"]).count() == 0
    assert L.route_regions(stops).count() == 0
    assert L.station_timetable(stops, "Stn3").count() == 3
    assert L.station_timetable(stops, "Stn3", train_type="EXP").count() == 0
    halts = L.route_halt_number(stops)
    assert halts.filter("train_number = '2'").agg({"halt_no": "max"}).first()[0] == 25
    assert S.busiest_search(A.busiest_stations(stops), "stn1").count() > 0
    assert all(r.ok for r in Q.stops_checks(stops).collect())
