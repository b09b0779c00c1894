import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from skiff.operators import trips as T

SCHEMA = (
    "trip_id long, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count int, "
    "trip_distance decimal(8,2), pickup_longitude decimal(10,6), pickup_latitude decimal(10,6), "
    "dropoff_longitude decimal(10,6), dropoff_latitude decimal(10,6), payment_type string, "
    "fare_amount decimal(8,2), tip_amount decimal(8,2), tolls_amount decimal(8,2), "
    "total_amount decimal(8,2), vendor_id string"
)
T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def _trip(i, secs, dist, fare, passengers=1, payment="Cash", vendor="CMT", coords=Decimal("1.5")):
    return (
        i, T0, T0 + dt.timedelta(seconds=secs), passengers, dist, coords, coords, coords, coords,
        payment, fare, Decimal("1.00"), None, Decimal("2.00"), vendor,
    )


def test_duration_speed_and_cap(spark):
    rows = [
        _trip(1, -300, Decimal("2.00"), Decimal("10.00")),  # dropoff before pickup → 0.1 min floor
        _trip(2, 0, Decimal("2.00"), Decimal("10.00")),
        _trip(3, 3, Decimal("2.00"), Decimal("10.00")),  # 0.05 min → floor 0.1
        _trip(4, 3600, Decimal("30.00"), Decimal("60.00")),
        _trip(5, 360, Decimal("100.00"), Decimal("300.00")),  # 100 miles in 6 min → capped 80
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.trip_id: r for r in T.enrich_trips(df).collect()}
    assert out[1].trip_duration_mins == Decimal("0.10") and out[1].speed_mph == Decimal("80.00")
    assert out[2].trip_duration_mins == Decimal("0.10")
    assert out[3].trip_duration_mins == Decimal("0.10")
    assert out[4].trip_duration_mins == Decimal("60.00") and out[4].speed_mph == Decimal("30.00")
    assert out[4].fare_per_mile == Decimal("2.00") and out[4].fare_category == "Premium"
    assert out[5].speed_mph == Decimal("80.00")


def test_speed_uses_rounded_duration(spark):
    # 100 s = 1.6667 min → rounded 1.67; 1 mile / (1.67/60) h = 35.928... → 35.93
    df = spark.createDataFrame([_trip(1, 100, Decimal("1.00"), Decimal("5.00"))], SCHEMA)
    r = T.enrich_trips(df).first()
    assert r.trip_duration_mins == Decimal("1.67") and r.speed_mph == Decimal("35.93")


def test_validity_and_normalisation_defaults(spark):
    rows = [
        _trip(1, 60, Decimal("0.00"), Decimal("5.00")),
        _trip(2, 60, None, Decimal("5.00")),
        _trip(3, 60, Decimal("1.00"), None),
        _trip(4, 60, Decimal("1.00"), Decimal("5.00"), passengers=None, payment=None, vendor="", coords=None),
        _trip(5, 60, Decimal("1.00"), Decimal("5.00"), passengers=0, payment=""),
        _trip(6, 60, Decimal("1.00"), Decimal("5.00"), passengers=3),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    rej = {r.trip_id: r.reason for r in T.rejected_trips(df).collect()}
    assert rej == {1: T.REJECT_DISTANCE, 2: T.REJECT_DISTANCE, 3: T.REJECT_FARE}
    norm = {r.trip_id: r for r in T.normalise_trips(df, F.lit(None).cast("timestamp")).collect()}
    assert sorted(norm) == [4, 5, 6]
    assert norm[4].passenger_count == 1 and norm[4].payment_type == "Unknown" and norm[4].vendor_id == "Unknown"
    assert norm[4].pickup_latitude == 0 and norm[4].tolls_amount == 0
    assert norm[5].passenger_count == 1 and norm[5].payment_type == "Unknown"
    assert norm[6].passenger_count == 3


def test_message_round_trip_and_bad_messages(spark):
    df = spark.createDataFrame([_trip(1, 90, Decimal("2.50"), Decimal("12.30"))], SCHEMA)
    norm = T.normalise_trips(df, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    msgs = T.to_trip_messages(norm)
    bad = spark.createDataFrame([("not json",), ('{"trip_id": "x"}',), (None,)], "value string")
    parsed = T.parse_trip_messages(msgs.unionByName(bad))
    direct = T.enrich_trips(norm.drop("event_timestamp")).first()
    via = T.enrich_trips(parsed).collect()
    assert len(via) == 1
    assert (via[0].fare_per_mile, via[0].speed_mph, via[0].trip_duration_mins) == (
        direct.fare_per_mile, direct.speed_mph, direct.trip_duration_mins)
    assert T.enrichment_rejects(parsed).count() == 3


def test_points_layout(spark):
    df = spark.createDataFrame([_trip(7, 600, Decimal("2.00"), Decimal("20.00"))], SCHEMA)
    pts = T.to_points(T.enrich_trips(df)).first()
    assert pts.measurement == "taxi_trips"
    assert (pts.payment_type, pts.vendor_id, pts.fare_category) == ("Cash", "CMT", "Medium")
    assert pts.trip_id == 7 and pts.trip_distance == 2.0 and pts.time == T0
    values = {r.field: r.value for r in T.point_values(T.to_points(T.enrich_trips(df))).collect()}
    assert set(values) == set(T.FIELD_COLUMNS) and values["trip_id"] == 7.0


def test_systematic_sample_positions(spark):
    rows = [_trip(i, 60, Decimal("1.00"), Decimal("5.00")) for i in range(1, 121)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(r.ordinal for r in T.systematic_sample(df).collect())
    assert got == [1, 2, 3, 4, 5, 50, 100]


def test_consumer_counts_from_measures_and_stored_points(spark):
    rows = [
        _trip(1, 600, Decimal("2.00"), Decimal("12.50")),
        _trip(2, 600, Decimal("3.00"), Decimal("12.50")),  # same series and time as trip 1
        _trip(3, 600, Decimal("2.00"), Decimal("30.00")),  # other fare category: own series
    ]
    points = T.to_points(T.enrich_trips(spark.createDataFrame(rows, SCHEMA)))
    measured = spark.createDataFrame([(4, 3, 1, 2, 1)], "consumed long, enriched long, enrich_errors long, sink_ok long, sink_error long")
    c = T.consumer_counts(measured, points).collect()[0].asDict()
    assert c == {"consumed": 4, "enriched": 3, "enrich_errors": 1, "sink_ok": 2, "sink_error": 1, "series_times": 2}


def test_offset_of_the_topic_orders_writes_of_one_batch(spark, tmp_dir):
    """Two messages of one trip in a micro-batch: the later offset is the last write."""
    from skiff.sinks.points import stored_points, write_points

    trip = ('{"trip_id":7,"pickup_datetime":"2024-01-01 08:00:00","dropoff_datetime":"2024-01-01 08:10:00","trip_distance":%s,'
            '"fare_amount":12.5,"payment_type":"Cash","vendor_id":"CMT"}')
    raw = spark.createDataFrame([(trip % "3.5", 11), (trip % "2.5", 10)], "value string, offset long")
    write_points(T.to_points(T.enrich_trips(T.parse_trip_messages(raw))), f"{tmp_dir}/points", 0)
    assert [r.trip_distance for r in stored_points(spark, f"{tmp_dir}/points").collect()] == [3.5]
