"""GeoJSON FeatureCollection handling.

A FeatureCollection file is one JSON document; each one becomes one row
with a ``features`` array.  Flattening explodes the features of every
document in parallel (one task per input split / document batch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_feature_collection(fc: DataFrame, fields: dict[str, str | Column], key: str) -> DataFrame:
    """One row per feature with the selected ``properties`` fields, trimmed.

    ``fields`` maps output name -> property name (or a Column over ``p``,
    the properties struct).  Rows whose ``key`` is null or blank after
    trimming are dropped; a feature with null properties has a null key.
    """
    props = fc.select(F.explode("features.properties").alias("p"))
    cols = []
    for out, src in fields.items():
        c = F.col(f"p.{src}") if isinstance(src, str) else src
        cols.append(F.trim(c.cast("string")).alias(out))
    flat = props.select(*cols)
    return flat.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def to_feature_collections(df: DataFrame, features_per_doc: int = 1000) -> DataFrame:
    """Pack attribute rows into FeatureCollection documents (one per row).

    Rows are grouped into documents of at most ``features_per_doc`` features,
    taken in input order within each partition, so no document (and no
    group) grows with the table.  Written with ``DataFrameWriter.json`` this
    yields one FeatureCollection per line.
    """
    doc = F.floor(F.monotonically_increasing_id() / F.lit(features_per_doc)).alias("_doc")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*df.columns).alias("properties"))
    return (df.select(doc, feature.alias("f"))
            .groupBy("_doc").agg(F.collect_list("f").alias("features"))
            .select(F.lit("FeatureCollection").alias("type"), "features"))
