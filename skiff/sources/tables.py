"""Parquet table access with early column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def read_table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """``spark.read.parquet(<root>/<name>.parquet)`` projected to ``columns``.

    Projection is declared at the scan so the parquet ReadSchema carries only the
    needed columns (Catalyst would prune anyway; stating it keeps plans readable).
    """
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only after proving it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. Beyond the bound the frame is
    returned unchanged and the planner keeps a shuffle join (AQE may still convert
    it at run time from measured sizes).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
