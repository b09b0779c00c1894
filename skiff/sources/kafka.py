"""Message-topic source and sink options (Structured Streaming's Kafka connector).

The connector jar is not part of the base PySpark distribution; these builders only
assemble options and call the connector, so they work wherever the jar is present
(``spark.jars.packages``). Offsets live in the query checkpoint, which replaces the
consumer group's auto-commit; ``trigger(availableNow=True)`` replaces "stop after
10 s without messages".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(
    brokers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_source(spark: SparkSession, brokers: str, topic: str, **kw) -> DataFrame:
    """Streaming read; ``value`` is cast to text so downstream parsing matches the
    file-backed stream."""
    raw = spark.readStream.format("kafka").options(**kafka_source_options(brokers, topic, **kw)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp")


def kafka_sink_options(
    brokers: str, topic: str, acks: str = "all", retries: int = 3, linger_ms: int = 10,
    retry_backoff_ms: int | None = None,
) -> dict[str, str]:
    """Producer settings of the reference publishers (acks, retries, linger, backoff)."""
    opts = {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.retries": str(retries),
        "kafka.linger.ms": str(linger_ms),
    }
    if retry_backoff_ms is not None:
        opts["kafka.retry.backoff.ms"] = str(retry_backoff_ms)
    return opts


def write_kafka(values: DataFrame, brokers: str, topic: str, **kw) -> None:
    """Batch publish of a ``value`` (and optional ``key``) column."""
    values.write.format("kafka").options(**kafka_sink_options(brokers, topic, **kw)).save()
