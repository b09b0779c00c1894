"""Distributed global row numbering (1-based) in a total order.

``row_number() OVER (ORDER BY ...)`` without a partition runs in a single task. Here:

1. ``orderBy`` range-partitions and sorts the data across all tasks;
2. each row gets (partition id, position in partition) from
   ``monotonically_increasing_id`` (= partition id << 33 | position);
3. the tagged rows are checkpointed to the shared checkpoint folder, pinning the
   partitioning so that re-execution (e.g. after a lost executor) cannot shift it;
4. per-partition row counts (one row per partition) give each partition's offset;
   that table is bounded by the number of partitions and is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skiff.session import scratch_root


def with_global_ordinal(df: DataFrame, order: Sequence[str | Column], name: str = "ordinal") -> DataFrame:
    """Add ``name`` = 1-based position of the row in ``order`` (which must be total)."""
    scratch_root(df.sparkSession)  # make sure a checkpoint folder is configured
    tagged = (
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + pos + F.lit(1))
        .drop("_pid", "_mid", "_off")
    )
