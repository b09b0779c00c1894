"""File sources: raw CSV (schema-on-read) and a JSON-lines directory stream that
stands in for a message topic (same contract: one text column ``value``)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Messages of a file below which a slice is written as a single one.
ROWS_PER_FILE = 1_000
#: Rows of a CSV file at most: a packed file is read by one task.
ROWS_PER_CSV = 1_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_raw_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Header row names the columns; every value stays a string (no inference)."""
    return (
        spark.read.format("csv")
        .option("header", "true")
        .option("inferSchema", "false")
        .option("encoding", encoding)
        .load(path)
    )


def write_raw_csv(parts: Iterable[DataFrame], path: str) -> None:
    """Write raw rows as CSV files with a header row, one part after another. The text is packed,
    and the shuffle files of a part go when it is written: disks hold those of one part."""
    for part in parts:
        spark = part.sparkSession
        before = spark.conf.get(SHUFFLE_CLEANUP, None)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            writer = part.write.mode("append").option("header", "true").option("maxRecordsPerFile", str(ROWS_PER_CSV))
            # level 4 of 9: an eighth smaller than the fastest; beyond it time grows faster than files shrink
            writer.option("compression", "gzip").option("zlib.compress.level", "FOUR").csv(path)
        finally:
            spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def raw_csv_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream over a folder of CSV files with one header (read once for the
    column names), ``maxFilesPerTrigger`` files a micro-batch."""
    names = read_raw_csv(spark, path).columns
    reader = spark.readStream.format("csv").option("header", "true").schema(", ".join(f"`{n}` string" for n in names))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def write_messages(values: DataFrame, path: str) -> None:
    """Write a ``value`` column as JSON-lines text files (one file per partition)."""
    values.select("value").write.mode("overwrite").text(path)


def write_slices(values: DataFrame, path: str, order: str = "slice") -> tuple[int, list[int]]:
    """Write messages (``value``) in arrival order: the slices one after another, each as the
    same number of files, so that a stream that takes that many files per trigger gets one
    slice per micro-batch. Returns that number and the rows of each slice."""
    rows = {r[order]: r["n"] for r in values.groupBy(order).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        write_messages(values, path)
        return 1, []
    return _append(path, [(values.filter(F.col(order) == k), lambda part: part, rows[k]) for k in sorted(rows)])


def write_built_slices(slices: Sequence[tuple[DataFrame, Callable[[DataFrame], DataFrame]]], path: str) -> tuple[int, list[int]]:
    """``write_slices`` for messages that are still to be built: each slice is its rows and what
    makes one message (``value``) of each. The short rows are dealt out, not the long texts."""
    counted = [(rows, build, rows.count()) for rows, build in slices]
    present = [s for s in counted if s[2]]
    if not present:
        rows, build = slices[0]
        write_messages(build(rows), path)
        return 1, []
    return _append(path, present)


def _append(path: str, slices: Sequence[tuple[DataFrame, Callable[[DataFrame], DataFrame], int]]) -> tuple[int, list[int]]:
    sizes = [n for _, _, n in slices]
    spread = slices[0][0].sparkSession.sparkContext.defaultParallelism
    files = max(1, min(spread, min(sizes) // ROWS_PER_FILE))
    for rows, build, _ in slices:
        # the text repeats its keys in every message: packed, it takes a fraction
        build(rows.repartition(files)).select("value").write.mode("append").option("compression", "gzip").text(path)
    return files, sizes


def json_file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over a directory of JSON-lines files (column ``value``).

    ``maxFilesPerTrigger`` paces the stream like a topic's ``maxOffsetsPerTrigger``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
