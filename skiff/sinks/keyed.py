"""Keyed result store for stream outputs: plain Parquet in folders by result day.

Layout: ``<root>/day=<date>/batch_id=<n>``. A micro-batch writes the rows it emitted
(update mode: the windows that changed) with dynamic partition overwrite, so a
replayed batch rewrites its own folders and a source that delivers at least once
yields effectively-once results. A batch writes only what it emitted, however much
is stored. Readers merge: the row with the highest ``batch_id`` wins per key,
computed with a partial aggregate (``max_by``), so no key — however hot — is
sorted in one task. Nothing is collected to the driver.

A window is emitted in the few batches between its first row and the watermark, so
the log holds a small multiple of the current table. Old results leave by whole
day folders (``drop_days``); what they added to the emission counters is first
rolled up into ``<root>_closed/day=<date>/upto=<n>``, one row per band.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skiff.operators.windows import latest_per_key

# ---------------------------------------------------------------------------
# Retention of the reference's result store.
#   result expiry 3600 s after the last update; newest 500 window keys kept in the
#   ranking; newest 100 entries kept in the recent feed.
# ---------------------------------------------------------------------------
RESULT_TTL_SECONDS = 3600
LATEST_KEYS_KEPT = 500
FEED_KEPT = 100


#: Rows of a folder above which one batch of a stateful query writes it as several files.
ROWS_PER_FILE = 500_000


def write_partitions(df: DataFrame, root: str, batch_id: int, by: Sequence[str] = ("day",), dealt: bool = False) -> None:
    """Write a batch's rows to ``<root>/<by...>/batch_id=<n>``; a replay of the batch
    rewrites the same folders and touches no other. Rows are rebalanced by folder, so
    a folder gets few files and a large one is still split over tasks (unless they are
    ``dealt`` so already)."""
    out = df.withColumn("batch_id", F.lit(batch_id))
    _overwrite(out if dealt else out.hint("rebalance", *[F.col(c) for c in by]), root, by)


def _overwrite(out: DataFrame, root: str, by: Sequence[str]) -> None:
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch_id").parquet(root)


def _write_by_folder(df: DataFrame, root: str, batch_id: int, by: str = "day") -> None:
    """``write_partitions`` for a stateful query, whose plans are not adaptive and so have no
    rebalancing: every state partition would write a file into every folder. The batch is
    counted by folder first (from its cached rows: the state is gone through once)."""
    df.persist()
    try:
        sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("folders"), F.max("n").alias("most")).first()
        split = -(-(sizes.most or 1) // ROWS_PER_FILE)
        tasks = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(1, sizes.folders * split))
        part = F.pmod(F.xxhash64(*df.columns), F.lit(split))
        _overwrite(df.withColumn("batch_id", F.lit(batch_id)).repartition(tasks, by, part), root, (by,))
    finally:
        df.unpersist()


def log_writer(
    root: str,
    key: Column,
    columns: Sequence[str],
    day: Column | None = None,
    clock: Column | None = None,
    on_written: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function storing each micro-batch under the day of its results
    (``day``, default: the window's start). ``clock`` gives ``updated_at`` (default: the
    time of writing). An empty micro-batch stores nothing."""
    day = day if day is not None else F.to_date("window_start")
    clock = clock if clock is not None else F.current_timestamp()

    def write(batch_df: DataFrame, batch_id: int) -> None:
        out = batch_df.select(key.alias("key"), *[F.col(c) for c in columns], clock.alias("updated_at"), day.alias("day"))
        adaptive = out.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        (write_partitions if adaptive else _write_by_folder)(out, root, batch_id)
        if on_written:
            on_written(batch_df, batch_id)

    return write


def read_log(spark: SparkSession, root: str, schema: StructType | str | None = None, since: dt.date | None = None) -> DataFrame:
    """Every stored emission with its ``day`` and ``batch_id`` (folder names); only the
    folders from day ``since`` on are read. ``schema`` stands in for an empty store."""
    try:
        log = spark.read.parquet(root)
    except AnalysisException:
        if schema is None:
            raise
        return spark.createDataFrame([], schema)
    return log if since is None else log.filter(F.col("day") >= F.lit(since))


def latest(log: DataFrame, key: str = "key") -> DataFrame:
    """Current value of every key: the emission with the highest batch_id."""
    values = [c for c in log.columns if c != key]
    return latest_per_key(log, [key], ["batch_id"], values)


def current(spark: SparkSession, root: str, key: str = "key", since: dt.date | None = None) -> DataFrame:
    """The current table: latest version per key."""
    return latest(read_log(spark, root, since=since), key)


def expire(df: DataFrame, ttl_seconds: int = RESULT_TTL_SECONDS, now: Column | None = None,
           updated_col: str = "updated_at") -> DataFrame:
    """Drop rows not updated within ``ttl_seconds`` of ``now`` (default: query time)."""
    now = now if now is not None else F.current_timestamp()
    return df.filter(F.col(updated_col) > now - F.make_dt_interval(secs=F.lit(ttl_seconds)))


def last_update(stored: DataFrame, updated_col: str = "updated_at") -> Column:
    """The store's newest ``updated_at`` as a scalar subquery (planned with the query that
    uses it, no job of its own)."""
    return stored.agg(F.max(updated_col)).scalar()


def retain_latest(df: DataFrame, n: int = LATEST_KEYS_KEPT, score: str = "window_ts", key: str = "key") -> DataFrame:
    """The n keys with the highest score (ties: greater key first), as a ranking
    store keeps them. Top-k: each task keeps its own n best before the merge."""
    return df.select(key, score).orderBy(F.desc(score), F.desc(key)).limit(n)


# ------------------------------------------------------------------ counters
def band_counts(rows: DataFrame) -> DataFrame:
    """Records per band. Over ``latest`` rows: each window counted once, in its final
    band ("exact"). Over the whole log: every emission adds its whole count under
    the band it had then, as counter increments do ("emitted")."""
    return rows.groupBy("band").agg(F.sum("record_count").alias("count"))


def closed_root(root: str) -> str:
    return f"{root.rstrip('/')}_closed"


_CLOSED = "band string, count bigint, day date, upto int"


def _open(spark: SparkSession, root: str) -> DataFrame:
    """Emissions that no roll-up holds yet: of a rolled-up day, only later batches."""
    closed = read_log(spark, closed_root(root), _CLOSED).groupBy("day").agg(F.max("upto").alias("_upto"))
    log = read_log(spark, root).join(closed, "day", "left")
    return log.filter(F.col("_upto").isNull() | (F.col("batch_id") > F.col("_upto"))).drop("_upto")


def emitted_band_counts(spark: SparkSession, root: str) -> DataFrame:
    """Records per band summed over EVERY emission ever stored (counter increments):
    the roll-ups of dropped days plus the days still there."""
    closed = read_log(spark, closed_root(root), _CLOSED).select("band", "count")
    return band_counts(_open(spark, root)).unionByName(closed).groupBy("band").agg(F.sum("count").alias("count"))


def _days(spark: SparkSession, root: str):
    """(date, path) of the day folders (a listing on the driver: metadata only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(p) if fs.exists(p) else ():
        name = st.getPath().getName()
        try:
            out.append((dt.date.fromisoformat(name.removeprefix("day=")), st.getPath()))
        except ValueError:
            continue
    return fs, sorted(out, key=lambda d: d[0])


def drop_days(spark: SparkSession, root: str, before: dt.date, counters: bool = True) -> list[dt.date]:
    """Delete the folders of days before ``before``; returns the days. With ``counters`` their
    emissions are first rolled up per day and band. Doing it again, also after a failure
    between the two steps, changes nothing."""
    fs, days = _days(spark, root)
    old = [(d, p) for d, p in days if d < before]
    if not old:
        return []
    if counters:
        rows = _open(spark, root).filter(F.col("day") < F.lit(before))
        per_day = rows.groupBy("day", "band").agg(F.sum("record_count").alias("count"), F.max("batch_id").alias("_last"))
        upto = per_day.groupBy("day").agg(F.max("_last").alias("upto"))
        (per_day.drop("_last").join(upto, "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "upto").parquet(closed_root(root)))
    for _, path in old:
        fs.delete(path, True)
    return [d for d, _ in old]


def keep_newest_days(spark: SparkSession, root: str, days: int, counters: bool = True) -> list[dt.date]:
    """Drop the days that are ``days`` or more before the newest stored one."""
    _, stored = _days(spark, root)
    if not stored:
        return []
    return drop_days(spark, root, stored[-1][0] - dt.timedelta(days=days - 1), counters)


# ------------------------------------------------------------------ feed
def feed(log: DataFrame, n: int = FEED_KEPT) -> DataFrame:
    """Newest n feed entries: newest batch first; inside a batch, rows are pushed in
    ascending (window_ts, state) order, so the last pushed is first."""
    entry = F.to_json(
        F.struct(
            F.col("state").alias("state"),
            F.col("avg_aqi").alias("avg_aqi"),
            F.col("band").alias("band"),
            F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window"),
            F.col("record_count").alias("count"),
        )
    )
    return (
        log.orderBy(F.desc("batch_id"), F.desc("window_ts"), F.desc("state"))
        .limit(n)
        .select("batch_id", "window_ts", "state", entry.alias("entry"))
    )


def recent_feed(spark: SparkSession, root: str, n: int = FEED_KEPT) -> DataFrame:
    """The newest n feed entries of a store (it keeps FEED_KEPT, more cannot be asked for)."""
    if n > FEED_KEPT:
        raise ValueError(f"at most {FEED_KEPT} feed entries are kept, {n} were asked for")
    return feed(read_log(spark, root), n)


FEED_ENTRY = "state string, avg_aqi double, band string, window string, count bigint"


def read_feed(feed_df: DataFrame, n: int = 10) -> DataFrame:
    """Newest n entries decoded; entries that are not valid JSON are skipped."""
    top = feed_df.orderBy(F.desc("batch_id"), F.desc("window_ts"), F.desc("state")).limit(n)
    is_object = F.from_json("entry", "map<string,string>").isNotNull()  # a struct would come back with NULL fields
    return top.filter(is_object).select(F.from_json("entry", FEED_ENTRY).alias("e")).select("e.*")
