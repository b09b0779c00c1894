"""Relational table scans over JDBC, split into parallel range reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 500


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = 1,
    fetch_size: int = FETCH_SIZE,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """``spark.read.jdbc`` with ``fetchsize`` rows per round trip; with a partition
    column, ``num_partitions`` tasks each read one key range. Bounds that are not given are
    the source's own smallest and largest key (they only shape the ranges: rows outside
    them are still read by the first/last task)."""
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower_bound is None or upper_bound is None:
        key = _quoted(spark, url, partition_column)
        lo, hi = spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) bounds", properties=props).first()
        if lo is None:  # no rows, or no keys: one task is enough
            return spark.read.jdbc(url, table, properties=props)
        lower_bound, upper_bound = lo if lower_bound is None else lower_bound, hi if upper_bound is None else upper_bound
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=props,
    )


def _quoted(spark: SparkSession, url: str, column: str) -> str:
    """The column's name as the source's dialect quotes it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)


def day_ranges(days: Sequence[tuple[dt.date, int]], parts: int) -> list[tuple[dt.date, dt.date | None]]:
    """Consecutive [from, to) ranges of whole days with about equally many rows each (at most
    ``parts``; the last one is open). ``days``: every day's number of rows."""
    days = sorted(days)
    total, ranges, seen = sum(n for _, n in days), [], 0
    for k, (day, n) in enumerate(days):
        # a range begins where the rows before it reach the next multiple of total / parts
        if not ranges or seen * parts >= len(ranges) * total:
            ranges.append(day)
        seen += n
    return list(zip(ranges, [*ranges[1:], None]))


def read_jdbc_ordered(
    spark: SparkSession,
    url: str,
    table: str,
    time_column: str,
    then: Sequence[str] = (),
    parts: int = 8,
    fetch_size: int = FETCH_SIZE,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The table in order of a time column (and ``then``), read by ``parts`` tasks.

    The source counts its rows per day (one row a day comes back); days are joined to ranges of
    about equal size, and each task reads one range, so the partitions follow each other in
    time and sorting each of them orders the whole without a shuffle. Rows without a time
    come first, in a partition of their own. A day is not split: a source whose rows fall on
    few days is read by as few tasks."""
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    column = _quoted(spark, url, time_column)
    per_day = f"(SELECT CAST({column} AS DATE) AS day_of, COUNT(*) AS n FROM {table} GROUP BY CAST({column} AS DATE)) counted"
    counts = [(r[0], r[1]) for r in spark.read.jdbc(url, per_day, properties=props).collect()]
    ranges = day_ranges([(d, n) for d, n in counts if d is not None], parts)
    predicates = [f"{column} IS NULL"] if any(d is None for d, _ in counts) else []
    for k, (start, end) in enumerate(ranges):
        low = f"{column} IS NOT NULL" if k == 0 else f"{column} >= {_date(start)}"
        predicates.append(low if end is None else f"{low} AND {column} < {_date(end)}")
    if not predicates:
        return spark.read.jdbc(url, table, properties=props)
    rows = spark.read.jdbc(url, table, predicates=predicates, properties=props)
    return rows.sortWithinPartitions(time_column, *then)


def _date(day: dt.date) -> str:
    return f"{{ts '{day.isoformat()} 00:00:00'}}"  # the escape every JDBC driver takes
