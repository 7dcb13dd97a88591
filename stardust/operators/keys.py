"""Surrogate keys and dense positions without a global window.

A ``row_number()`` over an unpartitioned window moves every row into one task.
Instead: range-partition by the order (a distributed sort), count rows per
partition, prefix-sum those counts (a frame of one row per partition, joined
back by its id), and add each partition's offset to the row's index
inside its partition. The sorted frame (with partition id and position stored
as columns) is written to the shared folder first, so both passes see the
same rows even if an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def dense_index(df: DataFrame, order: list[Column], out: str = "seq", start: int = 0,
                partitions: int | None = None) -> DataFrame:
    """0-based (plus ``start``) position of every row in ``order``; equals
    ``row_number() over (order by ...) - 1 + start`` for a total order."""
    # A global sort is a range partitioning plus a sort inside each partition;
    # AQE merges adjacent small ranges, so partition ids stay in key order and
    # a small batch does not fan out into hundreds of tiny partitions.
    ordered = (df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
               if partitions else df.orderBy(*order))
    sorted_df = (ordered.withColumn("__pid", F.spark_partition_id())
                        .withColumn("__mid", F.monotonically_increasing_id()))
    # Cut lineage: both passes below read the same materialised rows, with each
    # row's partition id and position stored (so re-reads cannot reorder them).
    sorted_df = materialize(sorted_df, "dense-index")
    # One row per partition: its rows, and by a running sum where its positions begin.
    counts = sorted_df.groupBy("__pid").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) + start).alias("__off"))
    # Row index inside a partition = mid - (pid << 33) (how the id is built).
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return sorted_df.join(offsets, "__pid").withColumn(out, (F.col("__off") + local).cast("bigint")).drop("__pid", "__mid", "__off")


def assign_keys(new_rows: DataFrame, order: list[Column], key_col: str, max_existing: int | None) -> DataFrame:
    """K1: keys for new rows only: ``max(existing) + 1 + position``; never
    reuses a key (the maximum only grows)."""
    return dense_index(new_rows, order, key_col, start=(max_existing or 0) + 1)


def max_key(df: DataFrame, key_col: str) -> int:
    """A12 on a table: current maximum key (0 when empty)."""
    v = df.agg(F.max(key_col)).first()[0]
    return int(v) if v is not None else 0
