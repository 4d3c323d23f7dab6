"""Plan-shape guards: what the optimizer must (and must not) produce."""

import re

import pytest

import __spark_entry__ as entry
from stopflow.operators import analytics as A
from stopflow.operators import lookup as L
from stopflow.plans import queries as Q
from stopflow.sinks import publish as W
from stopflow.session import scratch_path
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_no_pair_explosion_or_single_task_window(spark, key):
    text = plan(entry.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", text):
        assert m.group(1).strip(), f"{key}: window without PARTITION BY"


@pytest.fixture(scope="module")
def published(spark):
    path = scratch_path(spark, "plan_guard_stops")
    W.write_table(Q.stops(spark, SF_SMALL), path, cluster_by=["station_name", "train_number"],
                  bloom_filter_columns=["train_number"])
    return spark.read.parquet(path)


def test_enrichment_is_two_broadcast_left_joins(spark):
    text = plan(Q.stops(spark, SF_SMALL))
    assert text.count("BroadcastHashJoin") >= 3  # two dimensions + the station names of the feed
    assert "SortMergeJoin" not in text


def test_top_n_is_take_ordered(published):
    assert "TakeOrderedAndProject" in plan(A.busiest_stations(published))
    assert "TakeOrderedAndProject" in plan(A.longest_trains(published))


def test_lookups_push_filters_and_prune_columns(published):
    tt = plan(L.station_timetable(published, "Supplier#000000003"))
    assert "EqualTo(station_name,Supplier#000000003)" in tt
    route = plan(L.route_itinerary(published, "1102"))
    assert "EqualTo(train_number,1102)" in route
    agg = plan(A.hourly_traffic(published))
    assert re.search(r"ReadSchema: struct<arrival:string>", agg)


def test_aggregates_combine_map_side(published):
    text = plan(A.station_traffic(published))
    assert "partial_count" in text  # partial aggregation before the exchange
    assert "partial_percentile_approx" in plan(A.stoppage_stats(published))
