"""Time-series point store on Parquet: one row per point, typed tags and fields.

Layout: ``<root>/day=<date>/tag=<payment type>/batch_id=<n>``, written per micro-batch with
dynamic partition overwrite (a replayed batch rewrites its own folders; a batch writes
its own points only, whatever is stored). A reader asks for days and a tag and reads
only those folders. Reading applies the store rule: one point per series and time, the
last write wins for the whole point. Writes are ordered by (batch, position), where the
position inside a batch is the source's (its columns in ``ORDER_IN_BATCH``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiff.operators.trips import FIELD_COLUMNS, ORDER_IN_BATCH, TAG_COLUMNS
from skiff.operators.windows import latest_per_key
from skiff.sinks.keyed import write_partitions

#: The tag that points are foldered by (a handful of values).
FOLDER_TAG = "payment_type"
SERIES = ("measurement", *TAG_COLUMNS, "time")


def write_points(points: DataFrame, root: str, batch_id: int, dealt: bool = False) -> None:
    """Store a batch's points (``operators.trips.to_points``); ``dealt`` as in ``write_partitions``."""
    out = points.withColumns({"day": F.to_date("time"), "tag": F.col(FOLDER_TAG)})
    write_partitions(out, root, batch_id, by=("day", "tag"), dealt=dealt)


def read_points(spark: SparkSession, root: str, since: dt.date | None = None, until: dt.date | None = None,
                tag: str | None = None) -> DataFrame:
    """Every point write of the days asked for (both inclusive) and, if given, of one
    payment type; other folders are not read."""
    log = spark.read.parquet(root)
    if since is not None:
        log = log.filter(F.col("day") >= F.lit(since))
    if until is not None:
        log = log.filter(F.col("day") <= F.lit(until))
    if tag is not None:
        log = log.filter((F.col("tag") == F.lit(tag)) & (F.col(FOLDER_TAG) == F.lit(tag)))
    return log


def stored_points(spark: SparkSession, root: str, since: dt.date | None = None, until: dt.date | None = None,
                  tag: str | None = None) -> DataFrame:
    """measurement, tags, time and fields: one row per series and time, as last written."""
    log = read_points(spark, root, since, until, tag)
    return latest_per_key(log, SERIES, ["batch_id", *ORDER_IN_BATCH], FIELD_COLUMNS)


def stored_series(spark: SparkSession, root: str) -> DataFrame:
    """measurement, tags and time of every point write (duplicates possible): only these
    columns are read, and nothing is merged."""
    return spark.read.parquet(root).select(*SERIES)
