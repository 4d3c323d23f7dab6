"""Batches through the ledger equal one clean run, retries and ended runs included."""

import random

import pytest
from pyspark.sql import functions as F

from stopflow.operators import clean as C
from stopflow.operators import ledger as G
from stopflow.plans import fixture as X

from tests.conftest import SF_SMALL

SCHEMA = "a int, `b.c` string, d double"


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_batches_equal_one_run(spark, tmp_dir):
    """Rows repeated within and across batches, nulls, columns with dots, replays."""
    rnd = random.Random(3)
    batches = [[(rnd.randrange(9), rnd.choice(["x", "y", "", None]), rnd.choice([0.5, None])) for _ in range(80)] for _ in range(4)] + [[], [(None, None, None)] * 3]
    frames = [spark.createDataFrame(b, SCHEMA).repartition(3) for b in batches]
    got = []
    for k, df in enumerate(frames):
        new = rows_of(G.new_rows(df, f"{tmp_dir}/ledger", f"batch-{k}", buckets=4))
        assert new == rows_of(G.new_rows(df, f"{tmp_dir}/ledger", f"batch-{k}", buckets=4))  # a replay
        got += new
    assert sorted(got) == rows_of(spark.createDataFrame(sum(batches, []), SCHEMA).distinct())
    assert G.listed_batches(spark, f"{tmp_dir}/ledger") == [f"batch-{k}" for k in range(6)]
    with pytest.raises(ValueError, match="batch name"):
        G.new_rows(frames[0], f"{tmp_dir}/ledger", "_x/y")


def test_ended_batch_is_done_again(spark, tmp_dir):
    """A batch that failed in mid-write, or wrote all but was not listed, adds nothing until it runs again."""
    ledger = f"{tmp_dir}/ledger"
    G.new_rows(spark.range(10).toDF("k"), ledger, "a")
    failing = spark.range(8, 40, numPartitions=3).select(F.when(F.col("id") == 39, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="lost"):
        G.new_rows(failing, ledger, "b")
    spark.range(100).selectExpr("id as k", "id as _row_hash", "cast(id % 64 as int) as _bucket").write.partitionBy("_bucket").parquet(f"{ledger}/c")
    assert G.listed_batches(spark, ledger) == ["a"]
    assert sorted(r.k for r in G.new_rows(spark.range(8, 12).toDF("k"), ledger, "b").collect()) == [10, 11]
    assert sorted(r.k for r in G.new_rows(spark.range(9, 14).toDF("k"), ledger, "c").collect()) == [12, 13]


def test_equal_hashes_are_compared(spark, tmp_dir, monkeypatch):
    """Rows of one hash stay apart by their bytes."""
    monkeypatch.setattr(G.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    G.new_rows(spark.range(5).toDF("k"), f"{tmp_dir}/l", "a")
    assert sorted(r.k for r in G.new_rows(spark.range(3, 9).toDF("k"), f"{tmp_dir}/l", "b").collect()) == [5, 6, 7, 8]


def test_only_matching_buckets_are_read(spark, tmp_dir):
    """A batch of one row scans one bucket of the ledger."""
    G.new_rows(spark.range(500).toDF("k"), f"{tmp_dir}/l", "a", buckets=16)
    old = G._stored(spark, f"{tmp_dir}/l", ["a"], "k long, _row_hash long, _bucket int")
    plan = old.filter(F.col("_bucket").isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [(_bucket" in plan
    assert {r[0] for r in old.filter("_bucket = 3").select(F.input_file_name()).collect()} < {r[0] for r in old.select(F.input_file_name()).collect()}


def test_clean_batches(spark, tmp_dir):
    """The feed in three batches, one sent twice, is what one clean run gives."""
    raw = X.raw_stops(spark, SF_SMALL)
    parts = [raw.filter(F.pmod(F.xxhash64("id", "arrival"), F.lit(3)) == k) for k in range(3)] + [raw.limit(200)]
    got = [r for k, p in enumerate(parts) for r in rows_of(G.clean_batch(p, f"{tmp_dir}/l", str(k), buckets=4))]
    assert sorted(got) == rows_of(C.clean_stops(raw))
