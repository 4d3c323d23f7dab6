"""Sequence numbers within groups that stay balanced when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sends every row of a
group to one task; if one train holds a third of all stops, that task does
a third of the work.  :func:`number_within_groups` gives the same numbers
without that hot task:

1. a global sort on ``(g, k, all other columns)`` - range partitioning
   samples the full key, so a hot group is cut into many contiguous slices;
   rows that agree in every column are interchangeable;
2. each row gets its position inside its group's slice of its partition, and
   whether that slice is the partition's first, and the row its last; this
   table is written once to the shared checkpoint folder, which pins the
   positions and cuts the lineage;
3. only the first slice of a partition can go on from earlier ones.  The
   groups and lengths of the partitions' last slices, a row per partition,
   give the rows before it;
4. these offsets, a row per partition, are broadcast to the table, so that
   its rows aren't shuffled a second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopflow.session import materialize


def _starts(group: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before it; nulls are equal."""
    return np.diff(group.dictionary_encode("encode").indices.to_numpy(), prepend=-1) != 0


def _slices(group: str):
    """Adds _idx (1..n in the group's slice of the sorted partition), _first (of the first slice) and _last (the partition's last row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, length, slices = None, 0, 0

        def out(b: pa.RecordBatch, idx: np.ndarray, first: np.ndarray, ends: bool) -> pa.RecordBatch:
            last = np.zeros(b.num_rows, bool)
            last[-1] = ends
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(idx), pa.array(first), pa.array(last)], names=[*b.schema.names, "_idx", "_first", "_last"])

        for b in batches:
            if not b.num_rows:
                continue
            g, at = b.column(group), np.arange(b.num_rows, dtype=np.int64)
            starts = _starts(g)
            if held is not None:
                before = held[0].column(group)
                starts[0] = _starts(pa.concat_arrays([before.slice(len(before) - 1), g.slice(0, 1)]))[1]
                yield out(*held, False)
            begun = np.maximum.accumulate(np.where(starts, at, -1))
            idx = np.where(begun < 0, length + at + 1, at - begun + 1)
            number = slices + np.cumsum(starts)
            held, length, slices = (b, idx, number == 1), int(idx[-1]), int(number[-1])
        if held is not None:
            yield out(*held, True)
    return run


def number_within_groups(df: DataFrame, group: str, order: list[Column], name: str = "seq_no") -> DataFrame:
    """Add ``name`` = 1..n within each ``group`` in ``order``; ties go by the remaining columns."""
    cols = df.columns
    ranked = (df.orderBy(F.col(group).asc(), *order, *(F.col(c).asc() for c in cols if c != group))
              .withColumn("_part", F.spark_partition_id()))
    added = [T.StructField("_idx", T.LongType()), T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType())]
    ranked = materialize(ranked.mapInArrow(_slices(group), T.StructType([*ranked.schema.fields, *added])), "group_sequence", "zstd")
    heads = ranked.filter("_first and _idx = 1").select(F.col(group).alias("_g"), F.col("_part").alias("_p"))
    tails = ranked.filter("_last").select(F.col(group).alias("_h"), F.col("_part").alias("_q"), F.col("_idx").alias("_n"))
    offsets = (heads.join(F.broadcast(tails), F.col("_g").eqNullSafe(F.col("_h")) & (F.col("_q") < F.col("_p")))
               .groupBy("_p").agg(F.sum("_n").alias("_before")))
    joined = ranked.join(F.broadcast(offsets), F.col("_part") == F.col("_p"), "left")
    seq = (F.col("_idx") + F.when(F.col("_first"), F.coalesce("_before", F.lit(0))).otherwise(0)).cast("int")
    return joined.select(*cols, seq.alias(name))


def number_within_groups_window(df: DataFrame, group: str, order: list[Column], name: str = "seq_no") -> DataFrame:
    """Reference form with a window: one task per group (for small groups / tests)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("int"))
