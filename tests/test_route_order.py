"""First and last stops by one order, the catalogue's order, unique dimensions, and views that stay the caller's."""

import random

import pytest

from stopflow.operators import analytics as A
from stopflow.operators import enrich as E
from stopflow.operators import lookup as L
from stopflow.operators.joins import unique_on

STOP = "train_number string, train_name string, train_type string, station_code string, station_name string, arrival string, departure string, day int, stop_sequence int, state string, zone string, stop_duration_mins int"


def stop(train, name, code, arrival, departure, seq):
    return (train, name, f"type of {name}", code, f"name of {code}", arrival, departure, 1, seq, "s", "z", 2)


def test_ties_of_stop_sequence(spark):
    """Stops of one sequence number go by arrival, then departure, before their codes; all that is shown comes from one row."""
    rows = [stop("1", "late", "A", "09:00", "09:05", 1), stop("1", "early", "Z", "08:00", "08:30", 1), stop("1", "early too", "Y", "08:00", "08:10", 1),
            stop("1", "end", "B", "20:00", "20:01", 7), stop("1", "last", "A", "21:00", "21:01", 7), stop("1", "unknown", "M", None, "23:00", 7)]
    for seed in range(3):
        df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), STOP).repartition(3)
        ends = L.route_endpoints(df).first()
        assert (ends.origin, ends.destination) == ("name of Y (Y)", "name of A (A)")
        profile, entry = L.train_profiles(df).first(), L.train_catalog(df).first()
        assert (profile.origin, profile.destination) == (ends.origin, ends.destination)
        assert profile.train_name == entry.train_name == "early too" and profile.label == entry.label


def test_catalogue_is_ordered(spark):
    numbers = [f"{n:05d}" for n in random.Random(1).sample(range(90_000), 300)]
    df = spark.createDataFrame([stop(n, f"train {n}", "A", "09:00", "09:05", 1) for n in numbers], STOP).repartition(5)
    cat = L.train_catalog(df)
    assert [r.train_number for r in cat.collect()] == sorted(numbers)
    assert [r.train_number for r in L.train_search(cat, "7").collect()] == sorted(n for n in numbers if "7" in n)
    assert [r.train_number for r in L.train_search_fallback(cat, "nothing").collect()] == sorted(numbers)


@pytest.mark.parametrize("most", [64 << 20, 0])
def test_repeated_key_stops_the_job(spark, most):
    """In a broadcast and in a shuffle join; unique dimensions and rows without a key pass."""
    facts = spark.createDataFrame([stop("1", "t", c, "09:00", "09:05", 1) for c in ("A", "B", "C", None)], STOP).drop("state", "zone")
    dim = lambda rows: spark.createDataFrame(rows, "_station_key string, state string, zone string")
    good = E.enrich_station(facts, dim([("A", "s", "z"), (None, "x", "x"), (None, "y", "y")]), max_broadcast_bytes=most)
    assert sorted((r.station_code or "", r.state) for r in good.collect()) == [("", None), ("A", "s"), ("B", None), ("C", None)]
    with pytest.raises(Exception, match="several dimension rows for _station_key B"):
        E.enrich_station(facts, dim([("A", "s", "z"), ("B", "s", "z"), ("B", "t", "z")]), max_broadcast_bytes=most).collect()
    trains = spark.createDataFrame([("1", "a"), ("1", "a")], "_train_key string, train_type string")
    with pytest.raises(Exception, match="several dimension rows for _train_key 1"):
        E.enrich_train(facts.drop("train_type"), trains, max_broadcast_bytes=most).collect()


def test_guard_reads_the_dimension_only(spark):
    """The check adds no pass over the stops: they are in the plan once, and not shuffled for it."""
    facts = spark.range(1000).selectExpr("cast(id % 7 as string) as train_number")
    dim = spark.range(7).selectExpr("cast(id as string) as _train_key", "'x' as train_type")
    plan = E.enrich_train(facts, dim)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 1000") == 1 and "BroadcastHashJoin" in plan
    assert unique_on(dim, "_train_key").columns == dim.columns


def test_sql_forms_leave_views_alone(spark):
    """A view of the session named as the old ones were keeps its rows."""
    for name in ("stops_for_stoppage", "stops_for_longest"):
        spark.range(3).createOrReplaceTempView(name)
    df = spark.createDataFrame([stop("1", "t", "A", "09:00", "09:05", k) for k in range(25)], STOP)
    assert A.stoppage_stats_sql(spark, df).count() == 1 and A.longest_trains_sql(spark, df).count() == 1
    before = {t.name for t in spark.catalog.listTables()}
    assert all(spark.table(n).count() == 3 for n in ("stops_for_stoppage", "stops_for_longest"))
    assert {"stops_for_stoppage", "stops_for_longest"} <= before
