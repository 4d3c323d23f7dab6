"""Versioned tables: an ended write leaves the version before, and readers never see a part."""

import os

import pytest
from pyspark.sql import functions as F

from stopflow.plans.jobs import analyse_job, clean_job
from stopflow.schema import RAW_STOPS_JSON
from stopflow.sinks import versions as V

from tests.test_whole_inputs import put, stops


def test_ended_write_keeps_the_old_version(spark, tmp_dir):
    path = f"{tmp_dir}/t.parquet"
    with pytest.raises(ValueError, match="no version"):
        V.read_version(spark, path)
    V.publish_version(spark.range(100), path)
    before = V.read_version(spark, path)
    failing = spark.range(1000, numPartitions=4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        V.publish_version(failing, path)
    assert V.read_version(spark, path).count() == before.count() == 100
    assert len(V.versions(spark, path)) == 1
    # a part of a version, as a killed job leaves it, is no version either
    spark.range(5).write.parquet(f"{path}/v-part")
    assert V.read_version(spark, path).count() == 100
    V.publish_version(spark.range(7), path)
    assert V.read_version(spark, path).count() == 7 and before.count() == 100
    assert "v-part" in V.remove_unlisted(spark, path)
    assert V.remove_unlisted(spark, path) == [] and V.read_version(spark, path, 1).count() == 100


def test_old_versions_go(spark, tmp_dir):
    path = f"file://{tmp_dir}/t"
    made = [V.publish_version(spark.range(n + 1), path, keep=3) for n in range(5)]
    assert [v.number for v in made] == [1, 2, 3, 4, 5] and V.versions(spark, path) == made[2:]
    assert [V.read_version(spark, path, n).count() for n in (3, 4, 5)] == [3, 4, 5]
    with pytest.raises(ValueError, match="version 2"):
        V.read_version(spark, path, 2)
    assert sorted(os.listdir(f"{tmp_dir}/t")) == sorted(["_versions", *(v.folder for v in made[2:])])
    with pytest.raises(ValueError, match="current"):
        V.publish_version(spark.range(1), path, keep=0)


def test_two_writers_of_one_number(spark, tmp_dir, monkeypatch):
    """Both have counted the same versions: both are listed, all readers agree on one, and the next goes on from there."""
    path = f"{tmp_dir}/t"
    V.publish_version(spark.range(1), path)
    seen = V.versions(spark, path)
    with monkeypatch.context() as m:
        real = V.versions
        calls = iter([seen, None, seen, None])
        m.setattr(V, "versions", lambda s, p: next(calls) or real(s, p))
        both = [V.publish_version(spark.range(n), path, keep=9) for n in (2, 3)]
    assert [v.number for v in both] == [2, 2]
    assert V.read_version(spark, path).count() == (2 if max(both) == both[0] else 3)
    assert V.publish_version(spark.range(4), path, keep=9).number == 3 and V.read_version(spark, path).count() == 4


def test_versioned_jobs(spark, tmp_dir):
    """A failing clean run leaves the stops of the run before for the analysis."""
    import json

    feed = put(f"{tmp_dir}/feed.json", json.dumps(stops(0, 30)))
    clean_job(spark, feed, f"{tmp_dir}/out", raw_schema=RAW_STOPS_JSON, versioned=True)
    bad = put(f"{tmp_dir}/bad.json", json.dumps(stops(0, 3)) + "\n")
    put(bad, '{"number": "1"}\n{"number": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        clean_job(spark, bad, f"{tmp_dir}/out", raw_schema=RAW_STOPS_JSON, versioned=True)
    table = f"{tmp_dir}/out/stops.parquet"
    assert V.read_version(spark, table).count() == 30 and len(V.versions(spark, table)) == 1
    assert analyse_job(spark, table, f"{tmp_dir}/out", f"{tmp_dir}/out/clean_stats.json")["cleaned_rows"] == 30
