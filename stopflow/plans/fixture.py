"""Timetable-shaped inputs derived from the driver's TPC-H-like tables.

No timetable data ships with the test tables, so the raw stop feed and the
two attribute tables are derived views that plant every dirty case the
cleaning has to handle:

* order -> train, supplier -> station, line item -> stop,
  nation -> state, region -> zone, order priority -> train type;
* placeholder names/times (``None``, ``' NaN '``, ``'null'``, ``''``),
  malformed times (``'bad'``), padded codes, times crossing midnight,
  exact duplicate rows, rows without a train or a station, duplicate
  and missing attribute keys.

The modulo conditions below only choose which rows carry a planted defect
(or which attribute rows are left out, to create unmatched keys): every
line item of the base table appears in the feed, so the work of every
query grows with the tables.

The derivation is written with the DataFrame API; its SQL twin lives in
:mod:`stopflow.plans.oracle` and is what DuckDB runs for the cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.operators.joins import join_dimension


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet); Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c, width: int):
    return F.lpad(c.cast("string"), width, "0")


def _clock(minutes):
    """``HH:MM:00`` text of an integer minute-of-day."""
    return F.concat(_pad(F.floor(minutes / 60).cast("int"), 2), F.lit(":"), _pad(minutes % 60, 2), F.lit(":00"))


def raw_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw schedule feed (8 text-ish columns, source naming)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name")
    b = join_dimension(li, sup, "l_suppkey", "inner")
    base = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 53 + F.col("l_partkey") * 11)
    am = base % 1440
    dm = (base + F.col("l_quantity").cast("int")) % 1440
    ok, pk, ln, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber"), F.col("l_suppkey")
    t = b.select(
        F.when(pk % 103 == 0, F.lit(None).cast("string")).otherwise(ok.cast("string")).alias("number"),
        F.when(ok % 211 == 0, F.lit("None")).otherwise(F.concat(F.lit(" Service "), ok.cast("string"))).alias("trainName"),
        F.when(pk % 101 == 0, F.lit("none")).otherwise(F.concat(F.lit("S"), _pad(sk, 5), F.lit(" "))).alias("station"),
        F.col("s_name").alias("station_name"),
        F.when(ln == 1, F.lit("None")).when(pk % 97 == 0, F.lit(" NaN ")).when(pk % 83 == 0, F.lit("bad"))
         .otherwise(_clock(am)).alias("arrival"),
        F.when(ln == 7, F.lit("")).when(pk % 89 == 0, F.lit("null"))
         .otherwise(F.concat(F.lit(" "), _clock(dm))).alias("departure"),
        (F.lit(1) + F.floor((ln - 1) / 2)).cast("int").alias("day"),
        (ln.cast("bigint") * 1000000000 + pk * 10000 + sk).alias("id"),
        # Planted exact duplicates: two copies of every row whose part key is a
        # multiple of 53 - generated from one scan, not a second pass.
        F.explode(F.when(pk % 53 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return t.drop("_copy")


def station_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station attributes: padded codes, a blank state, a ``'?'`` zone,
    stations without attributes, and codes listed twice."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nat.join(reg, nat.n_regionkey == reg.r_regionkey)  # 25 x 5 rows
    code = F.concat(F.lit("S"), _pad(F.col("s_suppkey"), 5))
    main = (join_dimension(sup.filter(F.col("s_suppkey") % 25 != 0),
                           geo.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey", "inner")
            .select(F.concat(F.lit(" "), code).alias("code"),
                    F.when(F.col("s_nationkey") == 9, F.lit("")).otherwise(F.col("n_name")).alias("state"),
                    F.when(F.col("s_nationkey") == 7, F.lit("?")).otherwise(F.col("r_name")).alias("zone")))
    dups = sup.filter(F.col("s_suppkey") % 10 == 3).select(
        code.alias("code"), F.lit("ZZ_DUP").alias("state"), F.lit("ZZ").alias("zone"))
    return main.unionByName(dups)


def train_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train attributes: numeric key as text and a category; some trains missing."""
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderkey") % 50 != 0).select(
        F.col("o_orderkey").cast("string").alias("number"), F.col("o_orderpriority").alias("type"))
