"""Session helpers: sizing and the shared folder."""

from stopflow.session import cluster_conf, materialize, scratch_path, shared_dir


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # floor: 2 per core
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)


def test_shared_folder_and_materialize(spark):
    root = shared_dir(spark)
    assert root
    p = scratch_path(spark, "x")
    assert p.startswith(root.rstrip("/")) and p != scratch_path(spark, "x")
    df = materialize(spark.range(10).selectExpr("id", "monotonically_increasing_id() AS m"), "t")
    assert sorted(r.id for r in df.collect()) == list(range(10))
    assert df.collect() == df.collect()  # values pinned by the written table
