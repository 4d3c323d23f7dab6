"""Queries that read all columns, both feature kinds and both JSON layouts."""

import pytest

from stopflow.plans import queries
from stopflow.plans.queries import QUERIES
from stopflow.sources.files import is_json_array
from stopflow.sources.paths import data_files
from stopflow.sources.ranges import split_size
from tests.conftest import SF_SMALL

COLUMNS = {
    "profile_sample": ["number", "trainName", "station", "station_name", "arrival", "departure", "day", "id"],
    "clean_names": ["id", "train_name", "station_code", "station_name"],
    "time_to_minutes": ["id", "arrival_min", "departure_min"],
    "geojson_flatten": ["code", "state", "zone"],
    "profile_sample_all": ["number", "trainName", "station", "station_name", "arrival", "departure", "day", "id"],
    "clean_all_names": ["id", "train_name", "station_code", "station_name"],
    "times_to_minutes": ["id", "arrival_min", "departure_min"],
    "geojson_trains": ["number", "type"],
}


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_columns(spark, key):
    assert QUERIES[key](spark, SF_SMALL).columns == COLUMNS[key]


def test_array_files(spark, monkeypatch):
    """Every file of the landed feed holds one array, and is read in several ranges."""
    seen = {}
    read = queries.R.read_json

    def spied(spark, path, *args, **kw):
        seen.update(path=path, split_bytes=kw["split_bytes"])
        return read(spark, path, *args, **{**kw, "split_bytes": 20_000})
    monkeypatch.setattr(queries.R, "read_json", spied)
    df = QUERIES["scan_json_array"](spark, SF_SMALL)
    files = data_files(spark, seen["path"])
    assert df.count() > 0 and all(is_json_array(spark, f) for f in files)
    with split_size(spark, 20_000):
        assert spark.read.option("lineSep", "}").text(files[0]).rdd.getNumPartitions() > 2
