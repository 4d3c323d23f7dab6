"""Enrichment joins, dimension dedup, GeoJSON flattening."""

from pyspark.sql import functions as F

from stopflow.operators import clean as C
from stopflow.operators import enrich as E
from stopflow.plans import fixture as X
from stopflow.sources.geojson import flatten_feature_collection, to_feature_collections
from tests.conftest import SF_SMALL


def _stops(spark):
    return C.clean_stops(X.raw_stops(spark, SF_SMALL))


def test_enrichment_preserves_rows_and_is_deterministic(spark):
    base = _stops(spark)
    sm, tm = X.station_meta(spark, SF_SMALL), X.train_meta(spark, SF_SMALL)
    out = E.enrich(base, E.station_dimension(sm), E.train_dimension(tm))
    assert out.count() == base.count() == 5902
    got = out.agg(F.count("state").alias("s"), F.count("train_type").alias("t")).first()
    assert (got.s, got.t) == (5365, 5788)


def test_broadcast_and_shuffle_paths_agree(spark):
    base = _stops(spark)
    sm = X.station_meta(spark, SF_SMALL)
    small = E.enrich_station(base, E.station_dimension(sm))
    big = E.enrich_station(base, E.station_dimension(sm), max_broadcast_bytes=0)  # size check fails -> shuffle join
    plan_small = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan_small
    cols = ["train_number", "stop_sequence", "state", "zone"]
    assert sorted(small.select(cols).collect()) == sorted(big.select(cols).collect())


def test_dim_dedup_min_per_attribute(spark):
    dim = spark.createDataFrame([(" A ", "s2", "z1"), ("A", "s1", "z9"), ("B", None, "z"), ("", "x", "y"), (None, "x", "y")],
                                "code string, state string, zone string")
    out = E.dim_dedup(E.trim_attributes(dim, "code", ["state", "zone"]), "code").orderBy("code").collect()
    assert [tuple(r) for r in out] == [("A", "s1", "z1"), ("B", None, "z")]


def test_geojson_flatten_edge_cases(spark):
    rows = [("FeatureCollection", [("Feature", (" S1 ", "St", "Z")), ("Feature", ("", "x", "y")),
                                   ("Feature", None), ("Feature", ("S1", "dup", "dup"))])]
    schema = ("type string, features array<struct<type:string, properties:struct<code:string,state:string,zone:string>>>")
    fc = spark.createDataFrame(rows, schema)
    flat = flatten_feature_collection(fc, {"code": "code", "state": "state", "zone": "zone"}, "code")
    assert sorted(tuple(r) for r in flat.collect()) == [("S1", "St", "Z"), ("S1", "dup", "dup")]
    dim = E.station_dimension_from_geojson(fc).collect()
    assert [tuple(r) for r in dim] == [("S1", "St", "Z")]


def test_feature_collections_round_trip(spark):
    sm = X.station_meta(spark, SF_SMALL)
    docs = to_feature_collections(sm, features_per_doc=3)
    sizes = [r[0] for r in docs.select(F.size("features")).collect()]
    assert max(sizes) <= 3 and sum(sizes) == sm.count()
    flat = flatten_feature_collection(docs, {"code": "code", "state": "state", "zone": "zone"}, "code")
    assert flat.count() == sm.count()


def test_unmatched_keys(spark):
    stops = spark.createDataFrame([("S1",), ("S2",), ("S2",), (None,)], "station_code string")
    dim = spark.createDataFrame([("S1",)], "code string")
    assert [r[0] for r in E.unmatched_keys(stops, dim, "station_code", "code").collect()] == ["S2"]
