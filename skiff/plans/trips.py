"""Contract queries of the taxi-trip flow (source rows → producer → consumer → points)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiff.operators import trips as T
from skiff.plans.output import edge
from skiff.session import apply_defaults
from skiff.sources import fixtures


def source_trips(spark: SparkSession, root: str) -> DataFrame:
    apply_defaults(spark)
    return fixtures.trips(spark, root)


def consumed_trips(spark: SparkSession, root: str) -> DataFrame:
    """What the consumer receives: the producer's normalised, valid trips (the
    wall-clock ingestion stamp is left out of contract results)."""
    return T.normalise_trips(source_trips(spark, root)).drop("event_timestamp")


def q_trips_normalised(spark, root):
    return edge(consumed_trips(spark, root))


def q_trips_ingested(spark, root):
    """Every published trip carries the time of its ingestion: stamped between the start of this
    query's planning and its end, with text that reads back as that time."""
    planned = F.lit(dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=1)).cast("timestamp")
    message = T.to_trip_messages(T.normalise_trips(source_trips(spark, root)), keep=("trip_id",))
    stamp = F.to_timestamp(F.get_json_object("value", "$.event_timestamp"))
    return message.select("trip_id", ((stamp >= planned) & (stamp <= F.current_timestamp())).alias("stamped"))


def q_trips_rejected(spark, root):
    return T.rejected_trips(source_trips(spark, root))


def q_trips_enriched(spark, root):
    return edge(T.enrich_trips(consumed_trips(spark, root)))


def q_trip_points(spark, root):
    return T.point_values(T.to_points(T.enrich_trips(consumed_trips(spark, root))))


def q_trip_sample(spark, root):
    # only what the sample shows and enrichment needs goes through the global
    # ordinal's range sort and checkpoint (Catalyst cannot prune through them)
    narrow = consumed_trips(spark, root).select(
        "trip_id", "pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount"
    )
    return edge(
        T.systematic_sample(narrow).select(
            "ordinal", "trip_id", "pickup_datetime", "fare_amount", "fare_category",
            "fare_per_mile", "speed_mph", "trip_duration_mins",
        )
    )


def q_trip_flow_counts(spark, root):
    return T.flow_counts(source_trips(spark, root))


def q_fare_category_counts(spark, root):
    return (
        T.enrich_trips(consumed_trips(spark, root))
        .groupBy("fare_category")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


QUERIES = {
    "trips_normalised": q_trips_normalised,
    "trips_ingested": q_trips_ingested,
    "trips_rejected": q_trips_rejected,
    "trips_enriched": q_trips_enriched,
    "trip_points": q_trip_points,
    "trip_sample": q_trip_sample,
    "trip_flow_counts": q_trip_flow_counts,
    "fare_category_counts": q_fare_category_counts,
}
