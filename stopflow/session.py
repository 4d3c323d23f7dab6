"""SparkSession construction and shared-folder resolution."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces/splits
# shuffle partitions at runtime from real sizes; skew-join splits hot keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # per-station sketches and per-train sets stay in hash maps up to this many
    # groups a task instead of falling back to a sort at 128
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "stopflow", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session.

    ``master`` and ``shuffle_partitions`` are left to the deployment when not
    given: on a cluster ``spark-submit`` sets the master, and the shuffle
    partition count should follow the data size (AQE coalesces small ones).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Size-dependent settings for a run over ``input_bytes`` of raw input.

    * scan splits of ``target_partition_bytes`` (fewer, fuller tasks);
    * an initial shuffle partition count that keeps every reducer near the
      target even before AQE coalesces (at least 2 per core), so the
      de-duplication shuffle never spills in oversized partitions;
    * AQE coalescing toward the same size, and skew-join splitting of any
      partition 5x the median and over 4x the target.

    The cleaning shuffle carries roughly the projected input, so the input
    size is the right order of magnitude for the shuffle size.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and hand-off tables.

    Taken from ``spark.checkpoint.dir`` of the running session.  Only a
    local-mode session without one (tests) gets a fresh temporary folder; on
    a cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_spark_subdir(current) else current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors "
                             "(intermediate tables and checkpoints are written there)")
        configured = tempfile.mkdtemp(prefix="stopflow-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def _is_spark_subdir(path: str) -> bool:
    # setCheckpointDir appends a random UUID folder to the configured root.
    last = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(last)
        return True
    except ValueError:
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder for an intermediate table."""
    root = shared_dir(spark)
    return f"{root.rstrip('/')}/stopflow/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and read it back.

    Cuts the lineage (a lost executor never forces recomputation past this
    point) and pins values of non-deterministic columns such as
    ``monotonically_increasing_id`` for every later use of the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file checks in local mode."""
    return path[5:] if path.startswith("file:") else path
