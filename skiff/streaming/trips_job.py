"""Taxi-trip consumer as a stream: decode → enrich → store, sample, count.

Each micro-batch writes into folders of its own (idempotent replay): the enriched
trips and the points by day, the rejected messages with reason and text, the sampled
trips, and one row of counters. Checkpointed offsets + idempotent writes replace the
reference's auto-committed consumer group (which could lose or repeat records).

The sample takes every 50th consumed message, so a micro-batch needs the number of
messages before it: the counters of the earlier batches, which are stored. A replayed
batch finds the same ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skiff.operators import trips as T
from skiff.sinks.keyed import write_partitions
from skiff.sinks.points import FOLDER_TAG, write_points

FLOW_METRICS = "trip_flow"
FLOW_COUNTERS = ("consumed", "enriched", "enrich_errors", "sink_ok", "sink_error")
SAMPLE_COLUMNS = ("trip_id", "pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount")


def read_flow(spark: SparkSession, out_root: str) -> DataFrame:
    """The counters of every micro-batch."""
    try:
        return spark.read.parquet(f"{out_root}/flow")
    except AnalysisException:  # nothing stored yet
        return spark.createDataFrame([], ", ".join(f"{c} long" for c in FLOW_COUNTERS) + ", batch_id int")


def flow_totals(spark: SparkSession, out_root: str) -> DataFrame:
    return read_flow(spark, out_root).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in FLOW_COUNTERS])


def _write_sample(batch: DataFrame, out_root: str, batch_id: int) -> None:
    spark = batch.sparkSession
    before = 0
    if batch_id:  # the first batch has none before it
        before = read_flow(spark, out_root).filter(F.col("batch_id") < batch_id).agg(F.sum("consumed")).first()[0] or 0
    narrow = batch.select(*SAMPLE_COLUMNS, "bad_value")  # only this goes through the ordinal's range sort
    write_partitions(T.systematic_sample(narrow, before=before).withColumn("day", F.to_date("pickup_datetime")),
                     f"{out_root}/sample", batch_id)


def trip_batch_writer(out_root: str, store: Callable[[DataFrame, str, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for decoded trips. ``store(points, root, batch_id)`` writes the
    points (default: the point store); where it fails, the batch's points are counted as sink
    errors and kept under ``<out_root>/unwritten`` instead, and the stream goes on."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        # a cached plan is adaptive too: its folders are rebalanced by their sizes
        batch_df.sparkSession.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
        batch_df.persist()
        enriched = None
        write_dealt = partial(write_points, dealt=True)
        try:
            n, bad = batch_df.agg(F.count(F.lit(1)), F.count_if(T.enrichment_error(batch_df))).first()  # one row
            good = n - bad
            # the trips and their points go to folders of the same days and tags: dealt out once for both
            enriched = T.enrich_trips(batch_df).withColumn("day", F.to_date("pickup_datetime"))
            enriched = enriched.hint("rebalance", F.col("day"), F.col(FOLDER_TAG)).persist()
            stored = enriched.drop("order_in_batch")
            points = T.to_points(enriched)

            def store_points() -> int:
                """Points that the sink did not take."""
                try:
                    (store or write_dealt)(points, f"{out_root}/points", batch_id)
                    return 0
                except Exception:  # the sink is down: nothing is lost, and the failure is counted
                    write_dealt(points, f"{out_root}/unwritten", batch_id)
                    return good

            # four independent outputs of the cached batch, written side by side
            with ThreadPoolExecutor(4) as pool:
                failed = pool.submit(store_points)
                others = [
                    pool.submit(write_partitions, T.enrichment_rejects(batch_df), f"{out_root}/rejects", batch_id, ()),
                    pool.submit(write_partitions, stored, f"{out_root}/enriched", batch_id, dealt=True),
                    pool.submit(_write_sample, batch_df, out_root, batch_id),
                ]
                for f in others:
                    f.result()
                failed = failed.result()
            counters = dict(zip(FLOW_COUNTERS, (n, good, bad, good - failed, failed)))
            row = batch_df.sparkSession.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in counters.items()])
            row.coalesce(1).write.mode("overwrite").parquet(f"{out_root}/flow/batch_id={batch_id}")
        finally:
            if enriched is not None:
                enriched.unpersist()
            batch_df.unpersist()

    return write


def start_trip_query(
    spark: SparkSession,
    source: Callable[[], DataFrame],
    out_root: str,
    checkpoint_root: str,
    trigger: dict | None = None,
    store: Callable[[DataFrame, str, int], None] | None = None,
) -> StreamingQuery:
    """Start the consumer stream. Its flow counters are also reported per micro-batch in
    ``progress.observedMetrics`` (see ``streaming.progress``)."""
    parsed = T.parse_trip_messages(source())
    bad = T.enrichment_error(parsed)
    parsed = parsed.observe(
        FLOW_METRICS,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(~bad).alias("enriched"),
        F.count_if(bad).alias("enrich_errors"),
    )
    return (
        parsed.writeStream.outputMode("append")
        .foreachBatch(trip_batch_writer(out_root, store))
        .option("checkpointLocation", f"{checkpoint_root}/trips")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .queryName(f"trip_enrichment_{uuid.uuid4().hex[:8]}")
        .start()
    )


def read_enriched(spark: SparkSession, out_root: str) -> DataFrame:
    return spark.read.parquet(f"{out_root}/enriched").drop("day", "batch_id", "event_timestamp")


def read_sample(spark: SparkSession, out_root: str) -> DataFrame:
    return spark.read.parquet(f"{out_root}/sample").drop("day", "batch_id")


def read_rejects(spark: SparkSession, out_root: str) -> DataFrame:
    """(trip_id, reason, message, batch_id) of every message that was not enriched."""
    return spark.read.parquet(f"{out_root}/rejects")
