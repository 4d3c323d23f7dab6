"""Skew-safe numbering within groups equals the window form, and splits a hot group."""

from pyspark.sql import functions as F

from stopflow.operators.ranking import number_within_groups, number_within_groups_window


def _skewed(spark):
    # one hot group holding a third of all rows, many small groups, some exact key ties
    hot = spark.range(0, 3000).select(F.lit("HOT").alias("g"), (F.col("id") % 1000).alias("k"))
    cold = spark.range(0, 6000).select(F.concat(F.lit("g"), (F.col("id") % 500).cast("string")).alias("g"),
                                      F.col("id").alias("k"))
    return hot.unionByName(cold).repartition(16)


def test_matches_window_form(spark):
    df = _skewed(spark)
    order = [F.col("k").asc()]
    a = number_within_groups(df, "g", order, "n")
    b = number_within_groups_window(df, "g", order, "n")
    # per (group, key): the set of numbers given to tied rows must agree
    agg = lambda x: x.groupBy("g", "k").agg(F.sort_array(F.collect_list("n")).alias("ns"))
    assert sorted(agg(a).collect()) == sorted(agg(b).collect())
    hot = a.filter("g = 'HOT'").agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(hot) == (1, 3000, 3000)


def test_hot_group_is_split_across_partitions(spark):
    """Range partitioning on (group, key, row id) cuts the hot group into several partitions.

    AQE coalescing is switched off here: on this tiny input it would merge all
    partitions into one, which at scale it does not (it targets ~128 MB each).
    """
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _skewed(spark)
        sorted_df = df.withColumn("_t", F.monotonically_increasing_id()).orderBy("g", "k", "_t")
        tagged = sorted_df.select("g", F.spark_partition_id().alias("p"))
        parts = tagged.filter("g = 'HOT'").select("p").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts >= 2


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["HOT", "HOT", "HOT", "a", "b"]), st.none()),
                          st.integers(0, 5)), min_size=1, max_size=300))
def test_numbering_matches_python_model(spark, rows):
    df = spark.createDataFrame(rows, "g string, k int").repartition(7)
    got = number_within_groups(df, "g", [F.col("k").asc()], "n").collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.k, r.n))
    for g, pairs in by_group.items():
        ks = sorted(k for k, _ in pairs)
        # numbers are exactly 1..size, and ordered consistently with k (ties in any order)
        assert sorted(n for _, n in pairs) == list(range(1, len(pairs) + 1))
        assert [k for k, _ in sorted(pairs, key=lambda p: p[1])] == ks
    assert sum(len(v) for v in by_group.values()) == len(rows)
