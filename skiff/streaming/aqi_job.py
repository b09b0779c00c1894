"""AQI continuous aggregation: decode → event time → watermark → tumbling and sliding
windows → keyed result store, as two streaming queries (each with its own source
read and checkpoint), output mode ``update``.

Scale notes: the stateful shuffle uses ``spark.sql.shuffle.partitions`` as fixed
at the query's first start (choose it before the first checkpoint); large state
should use the RocksDB state store provider (``rocksdb=True``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skiff.functions.timefmt import window_key
from skiff.operators.aqi import (
    DEFAULT_SLIDING, DEFAULT_TUMBLING, DEFAULT_WATERMARK, parse_aqi, rejected_messages, sliding, tumbling,
)
from skiff.sinks.keyed import keep_newest_days, log_writer, write_partitions

TUMBLING_COLUMNS = (
    "state", "window_start", "window_end", "avg_aqi", "max_aqi", "min_aqi", "record_count", "window_ts", "band",
)
SLIDING_COLUMNS = ("state", "window_start", "window_end", "avg_aqi", "record_count", "window_ts", "band")
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class AqiStreamConfig:
    tumbling: str = DEFAULT_TUMBLING
    sliding: tuple[str, str] | None = DEFAULT_SLIDING
    watermark: str = DEFAULT_WATERMARK
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    rocksdb: bool = False
    # keep the results of the newest k days; older day folders are dropped whole after a
    # micro-batch (their emission counters are rolled up first)
    keep_days: int | None = None
    # time of an update as it is stored (default: when it is written)
    clock: Column | None = None


def start_aqi_queries(
    spark: SparkSession,
    source: Callable[[], DataFrame],
    out_root: str,
    checkpoint_root: str,
    cfg: AqiStreamConfig | None = None,
) -> list[StreamingQuery]:
    """Start the tumbling and (unless ``cfg.sliding`` is None) the sliding query; returns the handles."""
    cfg = cfg or AqiStreamConfig()
    if cfg.rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    tag = uuid.uuid4().hex[:8]
    events = parse_aqi(source())

    def start(name: str, windows: DataFrame, key: str, columns, log: str, counters: bool) -> StreamingQuery:
        def retain(batch_df: DataFrame, batch_id: int) -> None:
            keep_newest_days(batch_df.sparkSession, f"{out_root}/{log}", cfg.keep_days, counters)

        writer = log_writer(
            f"{out_root}/{log}", window_key(key, F.col("state"), F.col("window_start")), columns,
            clock=cfg.clock, on_written=retain if cfg.keep_days else None,
        )
        return (
            windows.writeStream.outputMode("update")
            .foreachBatch(writer)
            .option("checkpointLocation", f"{checkpoint_root}/{name}")
            .trigger(**cfg.trigger)
            .queryName(f"aqi_{name}_{tag}")
            .start()
        )

    queries = [start("tumbling", tumbling(events, cfg.tumbling, watermark=cfg.watermark),
                     "window", TUMBLING_COLUMNS, "window_log", True)]
    if cfg.sliding:
        queries.append(start("sliding", sliding(events, *cfg.sliding, watermark=cfg.watermark),
                             "sliding", SLIDING_COLUMNS, "sliding_log", False))
    return queries


def start_reject_query(spark: SparkSession, source: Callable[[], DataFrame], out_root: str, checkpoint_root: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Store the messages that no window can take, with their reason, under ``<out_root>/rejects``."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        write_partitions(batch_df, f"{out_root}/rejects", batch_id, by=())

    return (
        rejected_messages(source()).writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint_root}/rejects")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .queryName(f"aqi_rejects_{uuid.uuid4().hex[:8]}")
        .start()
    )


def await_all(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for (availableNow) queries to finish; re-raise the first failure.

    With ``timeout_s`` a query still running at the deadline is stopped and a
    ``TimeoutError`` is raised instead of blocking the caller forever."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    for q in queries:
        if deadline is None:
            q.awaitTermination()
        elif not q.awaitTermination(max(deadline - time.monotonic(), 0.001)):
            for other in queries:
                other.stop()
            raise TimeoutError(f"streaming query {q.name} still running after {timeout_s} s")
    for q in queries:
        exc = q.exception()
        if exc is not None:
            raise RuntimeError(f"streaming query {q.name} failed: {exc}")


def await_any(spark: SparkSession) -> None:
    """Block until any active query ends (long-running deployment)."""
    spark.streams.awaitAnyTermination()
