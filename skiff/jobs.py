"""Command-line jobs (``spark-submit -m``-style: ``python -m skiff.jobs <job> ...``).

retail-report   raw order-line CSV → data-quality report tables (parquet)
retail-marts    raw order-line CSV → clean → four marts → parquet folder, catalog or JDBC
trip-publish    trip table (parquet or JDBC) → validate/normalise → JSON messages (files or Kafka)
trip-consume    JSON trip messages (files or Kafka) → enrich → enriched / rejects / points store
aqi-publish     air-quality CSV folder → messages, paced by files per trigger → files or Kafka
aqi-windows     JSON AQI messages (files or Kafka) → tumbling + sliding windows → keyed store; rejects
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from skiff.operators import aqi as A
from skiff.operators import clean, marts, quality
from skiff.operators import trips as T
from skiff.session import apply_defaults, new_run_dir
from skiff.sinks import tables
from skiff.sources import kafka
from skiff.sources.files import json_file_source, raw_csv_stream, read_raw_csv, write_messages
from skiff.sources.jdbc import read_jdbc_ordered
from skiff.streaming.aqi_job import AqiStreamConfig, await_all, await_any, start_aqi_queries, start_reject_query
from skiff.streaming.trips_job import start_trip_query


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("skiff").getOrCreate()
    return apply_defaults(spark)


def _source(spark: SparkSession, args) -> DataFrame:
    if args.brokers:
        return kafka.kafka_source(spark, args.brokers, args.topic, starting=args.starting)
    return json_file_source(spark, args.input, args.max_files_per_trigger)


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.trigger}


def _wait(spark: SparkSession, args, queries) -> None:
    """With --once until all queries have taken all input, else until one of them ends."""
    await_all(queries) if args.once else await_any(spark)


def retail_report(spark: SparkSession, args) -> None:
    rows, kept = quality.report_rows(read_raw_csv(spark, args.input))
    groups = new_run_dir(spark, "quality")  # one scan of the input; the parts read its few rows
    quality.report_groups(rows, kept).write.parquet(groups)
    for name, df in quality.report_from_groups(spark.read.parquet(groups), rows.schema).items():
        df.write.mode("overwrite").parquet(f"{args.output}/{name}")


def retail_marts(spark: SparkSession, args) -> None:
    bundle = marts.build_marts(clean.load_clean(read_raw_csv(spark, args.input)))
    if args.jdbc_url:
        for name, df in bundle.items():
            tables.write_jdbc(df, args.jdbc_url, name)
    elif args.database:
        tables.setup_namespace(spark, args.database)
        tables.swap_marts(bundle, args.database)
    else:
        for name, df in bundle.items():
            df.write.mode("overwrite").parquet(f"{args.output}/{name}")


def trip_publish(spark: SparkSession, args) -> None:
    if args.jdbc_url:
        src = read_jdbc_ordered(spark, args.jdbc_url, args.table, "pickup_datetime", ["trip_id"], args.partitions)
    else:
        src = spark.read.parquet(args.input)
    values = T.to_trip_messages(T.normalise_trips(src))
    T.rejected_trips(src).write.mode("overwrite").parquet(f"{args.output}_rejected")
    if args.brokers:
        kafka.write_kafka(values, args.brokers, args.topic)
    else:
        write_messages(values, args.output)


def trip_consume(spark: SparkSession, args) -> None:
    query = start_trip_query(spark, lambda: _source(spark, args), args.output, args.checkpoint, _trigger(args))
    _wait(spark, args, [query])


def aqi_publish(spark: SparkSession, args) -> None:
    # messages are stamped when their micro-batch is sent (the stream's current time)
    rows = raw_csv_stream(spark, args.input, args.max_files_per_trigger)
    values = A.to_json_value(A.build_aqi_messages(rows))
    if args.brokers:
        w = values.writeStream.format("kafka").options(**kafka.kafka_sink_options(
            args.brokers, args.topic, retries=5, retry_backoff_ms=1000))
    else:
        w = values.writeStream.format("text").option("path", args.output)
    query = w.option("checkpointLocation", args.checkpoint).trigger(**_trigger(args)).start()
    _wait(spark, args, [query])


def aqi_windows(spark: SparkSession, args) -> None:
    cfg = AqiStreamConfig(
        tumbling=args.window, watermark=args.watermark, trigger=_trigger(args), rocksdb=args.rocksdb,
        keep_days=args.keep_days,
    )
    source = lambda: _source(spark, args)
    queries = start_aqi_queries(spark, source, args.output, args.checkpoint, cfg)
    queries.append(start_reject_query(spark, source, args.output, args.checkpoint, _trigger(args)))
    _wait(spark, args, queries)


JOBS = {
    "retail-report": retail_report,
    "retail-marts": retail_marts,
    "trip-publish": trip_publish,
    "trip-consume": trip_consume,
    "aqi-publish": aqi_publish,
    "aqi-windows": aqi_windows,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m skiff.jobs", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--input")
    p.add_argument("--output")
    p.add_argument("--checkpoint", help="checkpoint folder (streams)")
    p.add_argument("--database")
    p.add_argument("--jdbc-url")
    p.add_argument("--table")
    p.add_argument("--partitions", type=int, default=8)
    p.add_argument("--brokers")
    p.add_argument("--topic")
    p.add_argument("--starting", default="latest")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--window", default=A.DEFAULT_TUMBLING)
    p.add_argument("--watermark", default=A.DEFAULT_WATERMARK)
    p.add_argument("--rocksdb", action="store_true")
    p.add_argument("--keep-days", type=int, help="results of how many days the window store keeps (default: all)")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = _session()
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])


__all__ = ["JOBS", "main"]
