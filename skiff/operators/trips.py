"""Taxi-trip operators: validate, normalise (producer side), enrich (consumer side),
time-series points, flow counters and the sampled console feed.

All per-row logic is native column expressions (no Python UDF); durations and
ratios are DECIMAL so rounding is HALF_UP on exact values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from skiff.functions.bands import fare_category
from skiff.functions.timefmt import python_datetime_text
from skiff.operators.aqi import REJECT_BAD_VALUE, REJECT_MISSING, REJECT_UNDECODABLE, reject_reason
from skiff.operators.ordinal import with_global_ordinal

# ---------------------------------------------------------------------------
# Message layout and enrichment constants of the trip flow.
#   duration floor 0.1 minutes, speed cap 80 mph, sample = first 5 then every 50th,
#   point measurement 'taxi_trips', tags payment_type / vendor_id / fare_category,
#   default text for a missing string 'Unknown'.
# ---------------------------------------------------------------------------
MIN_DURATION_MINUTES = "0.1"
MAX_SPEED_MPH = 80
SAMPLE_HEAD, SAMPLE_EVERY = 5, 50
MEASUREMENT = "taxi_trips"
UNKNOWN = "Unknown"
TAG_COLUMNS = ("payment_type", "vendor_id", "fare_category")
FIELD_COLUMNS = (
    "trip_id", "passenger_count", "trip_distance", "trip_duration_mins", "speed_mph",
    "fare_amount", "tip_amount", "tolls_amount", "total_amount", "fare_per_mile",
    "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
)
TRIP_COLUMNS = (
    "trip_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "payment_type", "fare_amount", "tip_amount", "tolls_amount", "total_amount", "vendor_id",
)
ENRICHED_COLUMNS = ("fare_per_mile", "trip_duration_mins", "speed_mph", "fare_category")

# JSON message published per trip: numbers as doubles, times as text.
TRIP_MESSAGE = StructType(
    [
        StructField("trip_id", LongType()),
        StructField("pickup_datetime", StringType()),
        StructField("dropoff_datetime", StringType()),
        StructField("passenger_count", IntegerType()),
        StructField("trip_distance", DoubleType()),
        StructField("pickup_longitude", DoubleType()),
        StructField("pickup_latitude", DoubleType()),
        StructField("dropoff_longitude", DoubleType()),
        StructField("dropoff_latitude", DoubleType()),
        StructField("payment_type", StringType()),
        StructField("fare_amount", DoubleType()),
        StructField("tip_amount", DoubleType()),
        StructField("tolls_amount", DoubleType()),
        StructField("total_amount", DoubleType()),
        StructField("vendor_id", StringType()),
        StructField("event_timestamp", StringType()),
    ]
)

REJECT_DISTANCE = "non_positive_distance"
REJECT_FARE = "non_positive_fare"
REJECT_NO_MILES = "zero_distance"
#: DECIMAL form of a trip's distance and money (a larger value is a bad one).
TRIP_NUMBER, TRIP_DEGREES = "decimal(18,6)", "decimal(16,10)"
_AMOUNTS = ("trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount")
_DEGREES = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
_TIMES = ("pickup_datetime", "dropoff_datetime")
_NEEDED = ("trip_distance", "fare_amount", "pickup_datetime", "dropoff_datetime")
_CORRUPT = "_corrupt_record"
#: Consumption order inside a micro-batch; also decides which write of a point is the last.
ORDER_IN_BATCH = ("order_in_batch", "trip_id")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ producer side
def validity_reason(distance: str | Column = "trip_distance", fare: str | Column = "fare_amount") -> Column:
    """NULL for a publishable trip, else why it is skipped (missing counts as 0)."""
    return (
        F.when(F.coalesce(_c(distance), F.lit(0)) <= 0, F.lit(REJECT_DISTANCE))
        .when(F.coalesce(_c(fare), F.lit(0)) <= 0, F.lit(REJECT_FARE))
    )


def valid_trips(df: DataFrame) -> DataFrame:
    return df.filter(validity_reason().isNull())


def rejected_trips(df: DataFrame) -> DataFrame:
    """(trip_id, reason) of the trips the producer skips."""
    return df.select("trip_id", validity_reason().alias("reason")).filter(F.col("reason").isNotNull())


def _text_or_unknown(c: str) -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(UNKNOWN))


def normalise_trips(df: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Producer-side normalisation of valid trips.

    NULL or zero passengers → 1; NULL coordinates and money → 0; NULL or empty
    text → 'Unknown'; distance and money rounded to 2 places; ingestion time added.
    """
    zero = F.lit(0)
    money = ("fare_amount", "tip_amount", "tolls_amount", "total_amount")
    coords = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    out = valid_trips(df).select(
        "trip_id",
        "pickup_datetime",
        "dropoff_datetime",
        F.when(F.coalesce(F.col("passenger_count"), zero) == 0, F.lit(1))
        .otherwise(F.col("passenger_count"))
        .cast("int")
        .alias("passenger_count"),
        F.round("trip_distance", 2).alias("trip_distance"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in coords],
        _text_or_unknown("payment_type").alias("payment_type"),
        *[F.round(F.coalesce(F.col(c), zero), 2).alias(c) for c in money],
        _text_or_unknown("vendor_id").alias("vendor_id"),
        (ingest_time if ingest_time is not None else F.current_timestamp()).alias("event_timestamp"),
    )
    return out.select(*TRIP_COLUMNS, "event_timestamp")


def to_trip_messages(normalised: DataFrame, keep: Sequence[Column] = ()) -> DataFrame:
    """One JSON ``value`` per trip in the message layout (numbers as doubles); columns in
    ``keep`` come along."""
    cols = []
    for f in TRIP_MESSAGE.fields:
        if f.name in ("pickup_datetime", "dropoff_datetime", "event_timestamp"):
            cols.append(python_datetime_text(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return normalised.select(F.to_json(F.struct(*cols)).alias("value"), *keep)


def parse_trip_messages(raw: DataFrame) -> DataFrame:
    """``value`` JSON text → typed trip rows, the ``message`` itself, and ``bad_value``: the first
    column whose value is there but is not of its type, not finite, or too large. Such and
    undecodable messages are rejected by enrichment instead of failing the query."""
    message = F.col("value").cast("string")
    layout = StructType([*TRIP_MESSAGE.fields, StructField(_CORRUPT, StringType())])
    place = F.col("offset") if "offset" in raw.columns else F.lit(0)  # a topic's offset, where the source has one
    m = raw.select(message.alias("message"), place.cast("long").alias("order_in_batch"),
                   F.from_json(message, layout, {"columnNameOfCorruptRecord": _CORRUPT}).alias("m"))
    m = m.select("message", "order_in_batch", "m.*")
    typed = {c: F.col(c).try_cast(TRIP_NUMBER) for c in _AMOUNTS} | {c: F.col(c).try_cast(TRIP_DEGREES) for c in _DEGREES}
    typed |= {c: F.try_to_timestamp(c).cast("timestamp_ntz") for c in _TIMES}
    lost = F.coalesce(*[F.when(F.col(c).isNotNull() & as_type.isNull(), F.lit(c)) for c, as_type in typed.items()])
    return m.withColumns({"bad_value": lost, **typed})


# ------------------------------------------------------------------ consumer side
def _duration_minutes() -> Column:
    micros = F.expr("timestampdiff(MICROSECOND, pickup_datetime, dropoff_datetime)").cast("decimal(20,0)")
    return F.round(
        F.greatest(micros / F.lit(60_000_000), F.expr(f"CAST({MIN_DURATION_MINUTES} AS DECIMAL(3,1))")), 2
    )


def enrichment_error(df: DataFrame) -> Column:
    """TRUE when a trip cannot be enriched: a needed input is missing, the distance is zero or,
    for decoded messages, some value is bad."""
    bad = F.coalesce(F.col("trip_distance") == 0, F.lit(False))
    for c in _NEEDED:
        bad = bad | F.col(c).isNull()
    for c in ("bad_value", _CORRUPT):
        if c in df.columns:
            bad = bad | F.col(c).isNotNull()
    return bad


def enrich_trips(df: DataFrame) -> DataFrame:
    """Add trip_duration_mins, fare_per_mile, speed_mph (from the ROUNDED duration,
    capped at 80) and fare_category; trips that cannot be enriched are dropped."""
    ok = df.filter(~enrichment_error(df)).drop("message", "bad_value", _CORRUPT)
    with_duration = ok.withColumn("trip_duration_mins", _duration_minutes())
    return with_duration.withColumns(
        {
            "fare_per_mile": F.round(F.try_divide(F.col("fare_amount"), F.col("trip_distance")), 2),
            "speed_mph": F.round(
                F.least(
                    F.try_divide(F.col("trip_distance") * F.lit(60), F.col("trip_duration_mins")),
                    F.lit(MAX_SPEED_MPH).cast("decimal(10,0)"),
                ),
                2,
            ),
            "fare_category": fare_category("fare_amount"),
        }
    )


def enrichment_rejects(df: DataFrame) -> DataFrame:
    """(trip_id, reason, message) of what cannot be enriched. Reasons tell apart messages that are
    no JSON object, missing keys, bad values and a zero distance; ``message`` is the text as it
    came (NULL for rows that were no messages)."""
    has = [c for c in ("message", "bad_value", _CORRUPT) if c in df.columns]
    message = F.col("message") if "message" in has else F.lit(None).cast("string")
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    if "message" in has:
        reason = reason.when(F.from_json(message, "map<string,string>").isNull(), F.lit(REJECT_UNDECODABLE))
    if "bad_value" in has:
        reason = reason.when(F.col("bad_value").isNotNull(), F.concat(F.lit(f"{REJECT_BAD_VALUE}:"), F.col("bad_value")))
    for c in _NEEDED:
        why = reject_reason(message, c) if "message" in has else F.lit(f"{REJECT_MISSING}:{c}")
        reason = reason.when(F.col(c).isNull(), why)
    reason = reason.when(F.col("trip_distance") == 0, F.lit(REJECT_NO_MILES)).otherwise(F.lit(REJECT_BAD_VALUE))
    return df.filter(enrichment_error(df)).select("trip_id", reason.alias("reason"), message.alias("message"))


def to_points(enriched: DataFrame, time_col: str = "pickup_datetime") -> DataFrame:
    """Time-series points, one row each: measurement, text tags, typed fields, time, and the
    point's place in its batch (a column ``order_in_batch`` of the source, if it has one)."""
    types = {"trip_id": "long", "passenger_count": "int"}
    place = F.col("order_in_batch").cast("long") if "order_in_batch" in enriched.columns else F.lit(0).cast("long")
    return enriched.select(
        F.lit(MEASUREMENT).alias("measurement"),
        *[F.col(t).cast("string").alias(t) for t in TAG_COLUMNS],
        F.col(time_col).alias("time"),
        *[F.col(f).cast(types.get(f, "double")).alias(f) for f in FIELD_COLUMNS],
        place.alias("order_in_batch"),
    )


def point_values(points: DataFrame) -> DataFrame:
    """One row per stored value: measurement, tag columns, time, field, value (double)."""
    keys = ["measurement", *TAG_COLUMNS, "time"]
    numbers = points.select(*keys, *[F.col(f).cast("double").alias(f) for f in FIELD_COLUMNS])
    return numbers.unpivot(keys, list(FIELD_COLUMNS), "field", "value")


def flow_counts(trips: DataFrame) -> DataFrame:
    """Producer and consumer counters in one pass over the source trips."""
    sent = validity_reason().isNull()
    # The producer normalises NULL money to 0 and only sends positive distance/fare,
    # so a sent trip fails enrichment only when a timestamp is missing.
    enrich_fail = F.col("pickup_datetime").isNull() | F.col("dropoff_datetime").isNull()
    return trips.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(sent).alias("sent"),
        F.count_if(~sent).alias("skipped"),
        F.count_if(sent).alias("consumed"),
        F.count_if(sent & ~enrich_fail).alias("enriched"),
        F.count_if(sent & enrich_fail).alias("enrich_errors"),
    )


def consumer_counts(measured: DataFrame, stored: DataFrame) -> DataFrame:
    """Consumer counters: ``measured`` is one row of the totals that the stream's metrics and its
    sink reported (consumed, enriched, enrich_errors, sink_ok, sink_error); series_times counts
    the distinct (series, time) of ``stored`` point writes. Both sides are one row."""
    series = stored.agg(F.count_distinct(F.struct("measurement", *TAG_COLUMNS, "time")).alias("n")).scalar()
    return measured.select("consumed", "enriched", "enrich_errors", "sink_ok", "sink_error", series.alias("series_times"))


def in_sample(position: Column, head: int = SAMPLE_HEAD, every: int = SAMPLE_EVERY) -> Column:
    return (position <= head) | (position % every == 0)


def systematic_sample(
    consumed: DataFrame,
    order: tuple[str, ...] = ("pickup_datetime", "trip_id"),
    head: int = SAMPLE_HEAD,
    every: int = SAMPLE_EVERY,
    before: int = 0,
) -> DataFrame:
    """Enriched trips whose position in the consumption order (1-based, counting
    trips that later fail enrichment too) is <= head or a multiple of ``every``.
    ``before`` rows were consumed earlier (a stream's earlier micro-batches)."""
    numbered = with_global_ordinal(consumed, list(order))
    numbered = numbered.withColumn("ordinal", F.col("ordinal") + F.lit(before))
    return enrich_trips(numbered.filter(in_sample(F.col("ordinal"), head, every)))
