"""Scaling experiment: the clean and analyse jobs on k copies of the derived feed.

Usage: python tools/scale_check.py [sf_dir] [k ...]

Copy i of the feed gets train numbers suffixed with ``-i`` (so copies are new
trains, not duplicates).  Prints rows and wall times per k; a plan that
scales keeps time per row flat or falling as k grows.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    ks = [int(k) for k in argv[2:]] or [1, 10]
    from pyspark.sql import functions as F

    from stopflow.plans import fixture as X
    from stopflow.plans.jobs import analyse_job, clean_job
    from stopflow.schema import RAW_STOPS_JSON
    from stopflow.session import get_session, scratch_path
    from stopflow.sources.geojson import to_feature_collections

    spark = get_session("scale-check", master="local[8]", shuffle_partitions=32)
    root = scratch_path(spark, "scale")
    raw = X.raw_stops(spark, sf_dir)
    to_feature_collections(X.station_meta(spark, sf_dir)).write.json(f"{root}/stations")
    to_feature_collections(X.train_meta(spark, sf_dir)).write.json(f"{root}/trains")
    for k in ks:
        # k copies of every row from a generator (no join), each copy its own trains
        feed = (raw.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
                   .withColumn("number", F.concat("number", F.lit("-"), F.col("_c").cast("string"))).drop("_c")
                if k > 1 else raw)
        feed.write.json(f"{root}/raw_{k}")
        t0 = time.time()
        stats = clean_job(spark, f"{root}/raw_{k}", f"{root}/out_{k}", f"{root}/stations", f"{root}/trains",
                          RAW_STOPS_JSON)
        t1 = time.time()
        analyse_job(spark, f"{root}/out_{k}/stops.parquet", f"{root}/out_{k}", f"{root}/out_{k}/clean_stats.json")
        t2 = time.time()
        n = stats["raw_rows"]
        print(f"k={k:3d} raw_rows={n:>10,d} clean={t1 - t0:6.1f}s analyse={t2 - t1:6.1f}s "
              f"us_per_row={(t2 - t0) / n * 1e6:6.2f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
