"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.session import materialize


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, wherever they were started."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` as its ``used`` columns and one struct, _rest, of all others, so that no other names can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, (F.struct(*rest) if rest else F.lit(None).cast("string")).alias("_rest"))


def restored(names: list[str], *used: str) -> list[Column]:
    """The columns ``names`` of what ``carried`` made, in their order."""
    return [F.col(c) if c in used else F.col("_rest")[c].alias(c) for c in names]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda.

    A column that is inlined into a higher-order function is evaluated again
    for every element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Total UTF-8 bytes of a text column (one small aggregate)."""
    return int(docs.agg(F.sum(F.octet_length(column))).first()[0] or 0)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def landed(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, whose shuffle files go as soon as the table is written, not when garbage is collected."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(_CLEANUP, before)


def range_bounds(df: DataFrame, key: str, n: int) -> list:
    """At most ``n - 1`` ascending cut points that split ``key`` evenly."""
    if n < 2:
        return []
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n)).first()[0]
    return sorted(set(cuts or []))


def range_of(key: str | Column, bounds: list) -> Column:
    """The number of cut points at or below ``key`` (0 for null keys)."""
    if not bounds:
        return F.lit(0)
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.size(F.filter(F.lit(bounds), lambda b: b <= k)), F.lit(0))


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component_id): the smallest id reachable from each vertex.

    ``vertices`` has a column ``id`` (distinct, not null), ``edges`` has ``u``
    and ``v`` (both vertices, any direction, repeats allowed).  Minimum labels
    travel over the edges, are hooked onto the label's own vertex and then
    shortcut, so the rounds grow with the logarithm of the longest path.
    Each round is written to the shared folder.  Only vertices with an edge
    take part; a hub's edges join a written table, so AQE can split them, and
    are reduced by a partial minimum before the shuffle.
    """
    e = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "edges")
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    label = materialize(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m"))
                        .select("id", F.least("id", "m").alias("l")), "labels")
    for _ in range(max_rounds):
        near = (both.join(label, both.v == label.id)
                .groupBy("u").agg(F.min("l").alias("near")))
        best = (label.join(near, label.id == near.u, "left")
                .select("id", F.col("l").alias("old"), F.least("l", F.coalesce("near", "l")).alias("l")))
        hooked = best.groupBy(F.col("old").alias("root")).agg(F.min("l").alias("hook"))
        step = (best.join(hooked, best.id == hooked.root, "left")
                .select("id", "old", F.least("l", F.coalesce("hook", "l")).alias("l")))
        step = materialize(step, "labels")
        jump = step.select(F.col("id").alias("at"), F.col("l").alias("next"))
        new = (step.join(jump, step.l == jump["at"], "left")
               .select("id", "old", F.least("l", F.coalesce("next", "l")).alias("l")))
        new = materialize(new, "labels")
        changed = new.filter("l <> old").limit(1).count()
        label = new.select("id", "l")
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (vertices.select("id").join(label.select(F.col("id").alias("of"), "l"), F.col("id") == F.col("of"), "left")
            .select("id", F.coalesce("l", "id").alias("component_id")))
