"""Enrichment: attach station and train attributes to stops.

Both are left outer equi-joins on a dimension that is first made unique on
its key, so enrichment never changes the number of stops; a dimension that
still has several rows for a key fails the job and names the key
(:func:`stopflow.operators.joins.unique_on`).  The dimensions
are broadcast when their size is proven small (see
:func:`stopflow.operators.joins.join_dimension`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, join_dimension, unique_on
from stopflow.sources.geojson import flatten_feature_collection


def trim_attributes(dim: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Trim key and attributes; drop rows with a null or blank key."""
    out = dim.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in [key, *attrs]])
    return out.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def dim_dedup(dim: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest value of each attribute (deterministic).

    Partial aggregation runs before the shuffle, so a key listed many times
    costs one row per map task.
    """
    attrs = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(*[F.min(c).alias(c) for c in attrs])


def station_dimension(station_attrs: DataFrame, code: str = "code") -> DataFrame:
    """Flat station attributes (code, state, zone) unique on the code."""
    flat = trim_attributes(station_attrs, code, ["state", "zone"])
    return dim_dedup(flat, code).withColumnRenamed(code, "_station_key")


def train_dimension(train_attrs: DataFrame, number: str = "number", ttype: str = "type") -> DataFrame:
    """Flat train attributes (number, train_type) unique on the number."""
    flat = trim_attributes(train_attrs.select(number, F.col(ttype).alias("train_type")), number, ["train_type"])
    return dim_dedup(flat, number).withColumnRenamed(number, "_train_key")


def station_dimension_from_geojson(fc: DataFrame) -> DataFrame:
    """Station attributes from FeatureCollection rows (``properties.code/state/zone``)."""
    flat = flatten_feature_collection(fc, {"code": "code", "state": "state", "zone": "zone"}, "code")
    return dim_dedup(flat, "code").withColumnRenamed("code", "_station_key")


def train_dimension_from_geojson(fc: DataFrame) -> DataFrame:
    """Train attributes from FeatureCollection rows (``properties.number/type``)."""
    flat = flatten_feature_collection(fc, {"number": "number", "train_type": "type"}, "number")
    return dim_dedup(flat, "number").withColumnRenamed("number", "_train_key")


def _matches(stops: DataFrame, key: str, dim_key: str) -> Column:
    """``key`` = ``dim_key``; in a shuffle join rows without a key are spread by a hash of the row, as they match nothing anyway.

    Of a row that has them, its place in the feed and its other key are
    hashed: a hash of all columns would carry those through the join's
    shuffle that nothing reads afterwards.
    """
    narrow = [c for c in ("stop_sequence", "train_number", "station_code") if c in stops.columns and c != key]
    spread = F.concat(F.lit("\0"), (F.xxhash64(*(narrow if "stop_sequence" in narrow else stops.columns)) % 1024).cast("string"))
    return (F.coalesce(F.col(key), spread) == F.col(dim_key)) & F.col(key).isNotNull()


def enrich_station(stops: DataFrame, stations: DataFrame,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, bound_by: DataFrame | None = None) -> DataFrame:
    """Left join state and zone on station_code = station key.

    ``bound_by`` (e.g. the attribute rows before de-duplication) makes the
    broadcast size check a plain scan-and-count.  A table without station
    codes is returned unchanged (there is nothing to join on).
    """
    if "station_code" not in stops.columns:
        return stops
    joined = join_dimension(stops, unique_on(stations, "_station_key"), _matches(stops, "station_code", "_station_key"), "left",
                            max_broadcast_bytes, bound_by)
    return joined.drop("_station_key")


def enrich_train(stops: DataFrame, trains: DataFrame,
                 max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, bound_by: DataFrame | None = None) -> DataFrame:
    """Left join train_type on train_number = train key (fact side untrimmed)."""
    joined = join_dimension(stops, unique_on(trains, "_train_key"), _matches(stops, "train_number", "_train_key"), "left",
                            max_broadcast_bytes, bound_by)
    return joined.drop("_train_key")


def enrich(stops: DataFrame, stations: DataFrame | None, trains: DataFrame | None,
           max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
           stations_bound: DataFrame | None = None, trains_bound: DataFrame | None = None) -> DataFrame:
    """Both enrichments; a missing dimension is skipped.

    Trains, the larger dimension as a rule, come first: if their join
    shuffles, the stations' attributes don't go along.
    """
    out, added = stops, []
    if trains is not None:
        out = enrich_train(out, trains, max_broadcast_bytes, trains_bound)
        added = out.columns[len(stops.columns):]
    if stations is not None:
        out = enrich_station(out, stations, max_broadcast_bytes, stations_bound)
    # the stations' attributes stand before the trains'
    names = [*(c for c in out.columns if c not in added), *added]
    return out.select(*(F.col(f"`{c}`") for c in names)) if len({*names}) == len(out.columns) else out


def unmatched_keys(stops: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Distinct fact keys with no dimension row (what the left join hides).

    The fact keys are de-duplicated first (partial aggregation), then
    anti-joined to the dimension keys, broadcast when their size is proven.
    """
    keys = stops.select(fact_key).filter(F.col(fact_key).isNotNull()).distinct()
    d = dim.select(F.col(dim_key).alias("_k")).filter(F.col("_k").isNotNull())
    return join_dimension(keys, d, F.col(fact_key) == F.col("_k"), "left_anti", max_broadcast_bytes)
