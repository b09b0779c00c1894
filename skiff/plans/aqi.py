"""Contract queries of the air-quality flow.

Batch queries window the messages directly; stream queries run the real streaming
jobs (JSON files → decode → watermark → windows → keyed store) over the same messages,
which arrive in several micro-batches, and read the stored results back. Contract window sizes fit
the 30-day event span: 1 h tumbling, 1 h / 15 min sliding, 10 min watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skiff.operators import aqi as A
from skiff.operators import serve
from skiff.operators import trips as T
from skiff.plans.output import edge
from skiff.session import apply_defaults, new_run_dir
from skiff.sinks import keyed
from skiff.sinks.points import stored_points, stored_series
from skiff.sources import fixtures
from skiff.sources.files import json_file_source, write_built_slices
from skiff.streaming.aqi_job import (
    SLIDING_COLUMNS, TUMBLING_COLUMNS, AqiStreamConfig, await_all, start_aqi_queries, start_reject_query,
)
from skiff.streaming.progress import ProgressTable, observed, read_progress
from skiff.streaming.trips_job import FLOW_METRICS, flow_totals, read_enriched, read_rejects, read_sample, start_trip_query

TUMBLING = "1 hour"
SLIDING = ("1 hour", "15 minutes")
WATERMARK = "10 minutes"
KEPT_DAYS = 15  # of the out-of-order run

_RUNS: dict[tuple[str, str, str], str] = {}


def messages(spark: SparkSession, root: str) -> DataFrame:
    apply_defaults(spark)
    return fixtures.aqi_messages(spark, root)


def _events(spark, root):
    return A.with_event_time(messages(spark, root))


def q_aqi_parsed(spark, root):
    parsed = A.parse_aqi(A.to_json_value(messages(spark, root)))
    return edge(parsed.select("state", "city", "aqi", "band", "event_time"))


def q_aqi_message_counts(spark, root):
    apply_defaults(spark)
    return A.message_counts(fixtures.aqi_csv_rows(spark, root))


def q_aqi_tumbling_batch(spark, root):
    return edge(A.tumbling(_events(spark, root), TUMBLING))


def q_aqi_sliding_batch(spark, root):
    return edge(A.sliding(_events(spark, root), *SLIDING))


# ------------------------------------------------------------------ stream runs
def _run_once(spark: SparkSession, root: str, label: str, start) -> str:
    """Run a paced stream to its end, once per application and input; returns its folder.

    ``start(run)`` writes the messages slice by slice and starts the queries over them with
    trigger availableNow; it returns (queries, rows of each slice, or a list of them a query). Every slice must have become
    one micro-batch, which the stored progress shows."""
    key = (spark.sparkContext.applicationId, root.rstrip("/"), label)
    if key in _RUNS:
        return _RUNS[key]
    apply_defaults(spark)
    run = new_run_dir(spark, label)
    table = ProgressTable(spark, f"{run}/progress")
    queries, slices = start(run)
    try:
        await_all(queries)
        table.close(queries)
    except BaseException:
        spark.streams.removeListener(table)
        raise
    got = read_progress(spark, f"{run}/progress") if slices else None
    for k, q in enumerate(queries if slices else ()):
        want = slices[k] if isinstance(slices[k], list) else slices
        rows = [r.rows_in for r in got.filter(F.col("query") == q.name).orderBy("batch_id").select("rows_in").collect()]
        if rows != want:  # one row a slice
            raise RuntimeError(f"{q.name} took {rows} messages a batch, the slices have {want}")
    _RUNS[key] = run
    return run


def aqi_stream_run(spark: SparkSession, root: str) -> str:
    """The tumbling, sliding and reject queries over the paced messages: a micro-batch per span
    of event time, and one of damaged messages."""

    def start(run):
        files, rows = write_built_slices(fixtures.aqi_paced(spark, root), f"{run}/input")
        source = lambda: json_file_source(spark, f"{run}/input", files)
        # the contract store's clock is event time, so that its rows are the same whenever it runs
        cfg = AqiStreamConfig(tumbling=TUMBLING, sliding=SLIDING, watermark=WATERMARK,
                              trigger={"availableNow": True}, clock=F.col("window_end"))
        queries = start_aqi_queries(spark, source, f"{run}/out", f"{run}/checkpoints", cfg)
        queries.append(start_reject_query(spark, source, f"{run}/out", f"{run}/checkpoints", {"availableNow": True}))
        return queries, rows

    return _run_once(spark, root, "aqi-stream", start)


def aqi_late_run(spark: SparkSession, root: str) -> str:
    """The tumbling query over messages that arrive out of order, twice: one store keeps every
    result, the other only those of the newest days."""

    def start(run):
        files, rows = write_built_slices(fixtures.aqi_late(spark, root), f"{run}/input")
        source = lambda: json_file_source(spark, f"{run}/input", files)
        queries = []
        for store, days in (("all", None), ("kept", KEPT_DAYS)):
            cfg = AqiStreamConfig(tumbling=TUMBLING, sliding=None, watermark=WATERMARK, trigger={"availableNow": True},
                                  keep_days=days, clock=F.col("window_end"))
            queries += start_aqi_queries(spark, source, f"{run}/{store}", f"{run}/checkpoints/{store}", cfg)
        return queries, rows

    return _run_once(spark, root, "aqi-late", start)


def _log(spark, root) -> str:
    return f"{aqi_stream_run(spark, root)}/out/window_log"


def window_results(spark, root) -> DataFrame:
    """Current tumbling results (latest per key)."""
    return keyed.current(spark, _log(spark, root))


def sliding_results(spark, root) -> DataFrame:
    return keyed.current(spark, f"{aqi_stream_run(spark, root)}/out/sliding_log")


def q_aqi_unexpired_windows(spark, root):
    """Windows updated within the store's time to live before its last update."""
    log = _log(spark, root)
    alive = keyed.expire(keyed.current(spark, log), now=keyed.last_update(keyed.read_log(spark, log)))
    return edge(alive.select("state", "window_start", "avg_aqi", "record_count", "band"))


def q_aqi_stream_rejects(spark, root):
    return spark.read.parquet(f"{aqi_stream_run(spark, root)}/out/rejects").select("message", "reason")


def q_aqi_late_rows(spark, root):
    """Per micro-batch of the out-of-order run: messages in, messages that reached a window (the
    growth of the emitted windows over what they had before), messages the watermark
    dropped, and the (window, state) groups Spark reports as dropped."""
    run = aqi_late_run(spark, root)
    log = keyed.read_log(spark, f"{run}/all/window_log").select("key", "record_count", "batch_id")
    before = F.lag("record_count", 1, 0).over(Window.partitionBy("key").orderBy("batch_id"))
    added = (log.select("batch_id", (F.col("record_count") - before).alias("more"))
             .groupBy("batch_id").agg(F.sum("more").alias("rows_added")))
    seen = read_progress(spark, f"{run}/progress").groupBy("batch_id").agg(  # both queries report the same
        F.max("rows_in").alias("rows_in"), F.max("groups_dropped").alias("groups_dropped"))
    return (seen.join(added, "batch_id", "left").withColumn("rows_added", F.coalesce("rows_added", F.lit(0)))
            .select("batch_id", "rows_in", "rows_added", (F.col("rows_in") - F.col("rows_added")).alias("rows_dropped"), "groups_dropped"))


def q_aqi_late_windows(spark, root):
    """Results of the days that the out-of-order run still keeps."""
    rows = keyed.current(spark, f"{aqi_late_run(spark, root)}/kept/window_log")
    return edge(rows.select("state", "window_start", "avg_aqi", "max_aqi", "min_aqi", "record_count", "band"))


def q_aqi_late_band_counts(spark, root):
    """Emission counters of that run, those of its dropped days included."""
    return keyed.emitted_band_counts(spark, f"{aqi_late_run(spark, root)}/kept/window_log")


def q_aqi_tumbling_stream(spark, root):
    return edge(window_results(spark, root).select(*TUMBLING_COLUMNS))


def q_aqi_sliding_stream(spark, root):
    return edge(sliding_results(spark, root).select(*SLIDING_COLUMNS))


def _text_start(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def q_aqi_window_results(spark, root):
    return _text_start(window_results(spark, root)).select(
        "state", "window_start", "avg_aqi", "max_aqi", "min_aqi", "record_count", "band"
    )


def q_aqi_sliding_results(spark, root):
    return _text_start(sliding_results(spark, root)).select(
        "state", "window_start", "avg_aqi", "record_count", "band"
    )


def _band_counts_exact(spark, root):
    return keyed.band_counts(window_results(spark, root))


def q_band_counts_exact(spark, root):
    return _band_counts_exact(spark, root)


def q_band_counts_emitted(spark, root):
    return _emitted(spark, root)


def _emitted(spark, root):
    return keyed.emitted_band_counts(spark, _log(spark, root))


def q_band_distribution(spark, root):
    return serve.band_distribution(_emitted(spark, root))


def q_dominant_band(spark, root):
    return serve.dominant_band(_emitted(spark, root))


def q_live_kpis(spark, root):
    return serve.live_kpis(window_results(spark, root))


def q_latest_per_state(spark, root):
    return edge(serve.latest_per_state(window_results(spark, root)))


def q_latest_500_windows(spark, root):
    return keyed.retain_latest(window_results(spark, root), keyed.LATEST_KEYS_KEPT)


def q_latest_500_sliding(spark, root):
    return keyed.retain_latest(sliding_results(spark, root), keyed.LATEST_KEYS_KEPT)


def q_recent_feed(spark, root):
    return keyed.read_feed(keyed.recent_feed(spark, _log(spark, root)), 10)


def q_timeline_50(spark, root):
    return edge(serve.timeline(window_results(spark, root), 50))


def q_newest_windows(spark, root):
    return edge(
        serve.newest_windows(window_results(spark, root), 20).select(
            "state", "window_start", "avg_aqi", "max_aqi", "record_count", "band"
        )
    )


def q_compare_windows(spark, root):
    return serve.compare_windows(window_results(spark, root), sliding_results(spark, root), 15)


def q_common_states(spark, root):
    return serve.common_states(window_results(spark, root), sliding_results(spark, root))


# ------------------------------------------------------------ trip stream (A1)
def trip_stream_run(spark: SparkSession, root: str) -> str:
    """The trip consumer over the paced messages: a micro-batch per span of pickup time, one of
    corrections and one of damaged messages. It ends after the first spans, and a second
    consumer takes over from its checkpoint."""
    apply_defaults(spark)
    messages = fixtures.trip_paced(spark, root)

    def start(run):
        queries, slices = [], []
        for part in (messages[:fixtures.TRIP_SLICES], messages[fixtures.TRIP_SLICES:]):
            await_all(queries)
            files, rows = write_built_slices(part, f"{run}/input")
            source = lambda: json_file_source(spark, f"{run}/input", files)  # noqa: B023, E731
            queries.append(start_trip_query(spark, source, f"{run}/out", f"{run}/checkpoints", {"availableNow": True}))
            slices.append(rows)
        return queries, slices

    return _run_once(spark, root, "trip-stream", start)


def q_trip_stream_enriched(spark, root):
    return edge(read_enriched(spark, f"{trip_stream_run(spark, root)}/out"))


def q_trip_stream_rejects(spark, root):
    return read_rejects(spark, f"{trip_stream_run(spark, root)}/out").select("message", "reason")


def q_trip_stream_sample(spark, root):
    return edge(read_sample(spark, f"{trip_stream_run(spark, root)}/out").select(
        "ordinal", "trip_id", "pickup_datetime", "fare_amount", "fare_category", "fare_per_mile", "speed_mph", "trip_duration_mins"))


def q_trip_points_stored(spark, root):
    return edge(stored_points(spark, f"{trip_stream_run(spark, root)}/out/points"))


def q_trip_pipeline_counts(spark, root):
    """Consumer counters: the stream's own metrics, the sink's, and the stored series."""
    run = trip_stream_run(spark, root)
    flow = observed(read_progress(spark, f"{run}/progress"), FLOW_METRICS, "consumed", "enriched", "enrich_errors")
    sink = flow_totals(spark, f"{run}/out").select("sink_ok", "sink_error")
    measured = flow.select("*", sink.select("sink_ok").scalar().alias("sink_ok"), sink.select("sink_error").scalar().alias("sink_error"))
    return T.consumer_counts(measured, stored_series(spark, f"{run}/out/points"))


QUERIES = {
    "aqi_parsed": q_aqi_parsed,
    "aqi_message_counts": q_aqi_message_counts,
    "aqi_tumbling_batch": q_aqi_tumbling_batch,
    "aqi_sliding_batch": q_aqi_sliding_batch,
    "aqi_tumbling_stream": q_aqi_tumbling_stream,
    "aqi_sliding_stream": q_aqi_sliding_stream,
    "aqi_window_results": q_aqi_window_results,
    "aqi_sliding_results": q_aqi_sliding_results,
    "band_counts_exact": q_band_counts_exact,
    "band_counts_emitted": q_band_counts_emitted,
    "band_distribution": q_band_distribution,
    "dominant_band": q_dominant_band,
    "live_kpis": q_live_kpis,
    "latest_per_state": q_latest_per_state,
    "latest_500_windows": q_latest_500_windows,
    "latest_500_sliding": q_latest_500_sliding,
    "aqi_unexpired_windows": q_aqi_unexpired_windows,
    "aqi_stream_rejects": q_aqi_stream_rejects,
    "aqi_late_rows": q_aqi_late_rows,
    "aqi_late_windows": q_aqi_late_windows,
    "aqi_late_band_counts": q_aqi_late_band_counts,
    "recent_feed": q_recent_feed,
    "timeline_50": q_timeline_50,
    "newest_windows": q_newest_windows,
    "compare_windows": q_compare_windows,
    "common_states": q_common_states,
    "trip_stream_enriched": q_trip_stream_enriched,
    "trip_stream_rejects": q_trip_stream_rejects,
    "trip_stream_sample": q_trip_stream_sample,
    "trip_points_stored": q_trip_points_stored,
    "trip_pipeline_counts": q_trip_pipeline_counts,
}
