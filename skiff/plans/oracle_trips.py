"""DuckDB twins of the taxi-trip contract queries."""

from __future__ import annotations

from skiff.plans.oracle_retail import cents, half_up, hundredths

_DEC = "CAST(value AS DECIMAL(10,2))"

CTES = f"""
trips AS (
  SELECT event_id AS trip_id, ts AS pickup_datetime,
         ts + to_seconds((event_id * 37) % 3600 - 600) AS dropoff_datetime,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(event_id % 7 AS INTEGER) END AS passenger_count,
         TRY_CAST(user_id * 0.17 AS DECIMAL(8,2)) AS trip_distance,
         CAST(-74.02 + (event_id % 900) * 0.0001 AS DECIMAL(10,6)) AS pickup_longitude,
         CAST(40.7 + (event_id % 1200) * 0.0001 AS DECIMAL(10,6)) AS pickup_latitude,
         CAST(-74.02 + ((event_id + 7) % 900) * 0.0001 AS DECIMAL(10,6)) AS dropoff_longitude,
         CAST(40.7 + ((event_id + 7) % 1200) * 0.0001 AS DECIMAL(10,6)) AS dropoff_latitude,
         CASE event_type WHEN 'view' THEN 'Credit Card' WHEN 'click' THEN 'Cash'
              WHEN 'signup' THEN 'No Charge' WHEN 'error' THEN 'Dispute' WHEN 'purchase' THEN '' END
           AS payment_type,
         {_DEC} AS fare_amount,
         CAST(ROUND({_DEC} * 0.1, 2) AS DECIMAL(10,2)) AS tip_amount,
         CAST(0 AS DECIMAL(10,2)) AS tolls_amount,
         CAST(ROUND({_DEC} * 1.1 + 0.5, 2) AS DECIMAL(10,2)) AS total_amount,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE ['CMT', 'VTS', 'DDS'][event_id % 3 + 1] END AS vendor_id
  FROM events
),
norm AS (
  SELECT trip_id, pickup_datetime, dropoff_datetime,
         CASE WHEN COALESCE(passenger_count, 0) = 0 THEN 1 ELSE passenger_count END AS passenger_count,
         ROUND(trip_distance, 2) AS trip_distance,
         COALESCE(pickup_longitude, 0) AS pickup_longitude, COALESCE(pickup_latitude, 0) AS pickup_latitude,
         COALESCE(dropoff_longitude, 0) AS dropoff_longitude, COALESCE(dropoff_latitude, 0) AS dropoff_latitude,
         COALESCE(NULLIF(payment_type, ''), 'Unknown') AS payment_type,
         ROUND(COALESCE(fare_amount, 0), 2) AS fare_amount, ROUND(COALESCE(tip_amount, 0), 2) AS tip_amount,
         ROUND(COALESCE(tolls_amount, 0), 2) AS tolls_amount, ROUND(COALESCE(total_amount, 0), 2) AS total_amount,
         COALESCE(NULLIF(vendor_id, ''), 'Unknown') AS vendor_id
  FROM trips
  WHERE COALESCE(trip_distance, 0) > 0 AND COALESCE(fare_amount, 0) > 0
),
dur AS (
  SELECT *, GREATEST({half_up("date_diff('microsecond', pickup_datetime, dropoff_datetime) * 100", "60000000")}, 10)
            AS dur_h
  FROM norm
),
enr AS (
  SELECT *, {half_up(f"{cents('fare_amount')} * 100", cents('trip_distance'))} AS fpm_h,
         LEAST({half_up(f"{cents('trip_distance')} * 6000", 'dur_h')}, 8000) AS speed_h,
         CASE WHEN fare_amount < 10 THEN 'Low' WHEN fare_amount < 25 THEN 'Medium'
              WHEN fare_amount < 50 THEN 'High' ELSE 'Premium' END AS fare_category
  FROM dur
),
again AS (SELECT * REPLACE (tip_amount + 1 AS tip_amount, total_amount + 1 AS total_amount) FROM enr WHERE trip_id % 60 = 0)"""

_NORM_OUT = """trip_id, pickup_datetime, dropoff_datetime, passenger_count,
       CAST(trip_distance AS DOUBLE) AS trip_distance,
       CAST(pickup_longitude AS DOUBLE) AS pickup_longitude, CAST(pickup_latitude AS DOUBLE) AS pickup_latitude,
       CAST(dropoff_longitude AS DOUBLE) AS dropoff_longitude, CAST(dropoff_latitude AS DOUBLE) AS dropoff_latitude,
       payment_type, CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(tip_amount AS DOUBLE) AS tip_amount,
       CAST(tolls_amount AS DOUBLE) AS tolls_amount, CAST(total_amount AS DOUBLE) AS total_amount, vendor_id"""

_ENR_OUT = f"""{hundredths('fpm_h')} AS fare_per_mile, {hundredths('dur_h')} AS trip_duration_mins,
       {hundredths('speed_h')} AS speed_mph, fare_category"""

_FIELDS = (
    ("trip_id", "CAST(trip_id AS DOUBLE)"),
    ("passenger_count", "CAST(passenger_count AS DOUBLE)"),
    ("trip_distance", "CAST(trip_distance AS DOUBLE)"),
    ("trip_duration_mins", hundredths("dur_h")),
    ("speed_mph", hundredths("speed_h")),
    ("fare_amount", "CAST(fare_amount AS DOUBLE)"),
    ("tip_amount", "CAST(tip_amount AS DOUBLE)"),
    ("tolls_amount", "CAST(tolls_amount AS DOUBLE)"),
    ("total_amount", "CAST(total_amount AS DOUBLE)"),
    ("fare_per_mile", hundredths("fpm_h")),
    ("pickup_latitude", "CAST(pickup_latitude AS DOUBLE)"),
    ("pickup_longitude", "CAST(pickup_longitude AS DOUBLE)"),
    ("dropoff_latitude", "CAST(dropoff_latitude AS DOUBLE)"),
    ("dropoff_longitude", "CAST(dropoff_longitude AS DOUBLE)"),
)


def _w(body: str) -> str:
    return f"WITH {CTES}\n{body}"


ORACLES = {
    "trips_normalised": _w(f"SELECT {_NORM_OUT} FROM norm"),
    "trips_rejected": _w(
        """SELECT trip_id, CASE WHEN COALESCE(trip_distance, 0) <= 0 THEN 'non_positive_distance'
                       ELSE 'non_positive_fare' END AS reason
FROM trips WHERE NOT (COALESCE(trip_distance, 0) > 0 AND COALESCE(fare_amount, 0) > 0)"""
    ),
    "trips_enriched": _w(f"SELECT {_NORM_OUT}, {_ENR_OUT} FROM enr"),
    "trips_ingested": _w("SELECT trip_id, TRUE AS stamped FROM norm"),
    "trip_points": _w(
        "\nUNION ALL\n".join(
            f"SELECT 'taxi_trips' AS measurement, payment_type, vendor_id, fare_category, "
            f"pickup_datetime AS time, '{name}' AS field, {expr} AS value FROM enr"
            for name, expr in _FIELDS
        )
    ),
    "trip_sample": _w(
        f"""SELECT ordinal, trip_id, pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount, fare_category,
       {hundredths('fpm_h')} AS fare_per_mile, {hundredths('speed_h')} AS speed_mph,
       {hundredths('dur_h')} AS trip_duration_mins
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY pickup_datetime, trip_id) AS ordinal FROM enr) t
WHERE ordinal <= 5 OR ordinal % 50 = 0"""
    ),
    "trip_flow_counts": _w(
        """SELECT COUNT(*) AS source_rows,
       CAST(COUNT_IF(COALESCE(trip_distance, 0) > 0 AND COALESCE(fare_amount, 0) > 0) AS BIGINT) AS sent,
       CAST(COUNT_IF(NOT (COALESCE(trip_distance, 0) > 0 AND COALESCE(fare_amount, 0) > 0)) AS BIGINT) AS skipped,
       CAST(COUNT_IF(COALESCE(trip_distance, 0) > 0 AND COALESCE(fare_amount, 0) > 0) AS BIGINT) AS consumed,
       CAST(COUNT_IF(COALESCE(trip_distance, 0) > 0 AND COALESCE(fare_amount, 0) > 0
                AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL) AS BIGINT) AS enriched,
       CAST(COUNT_IF(COALESCE(trip_distance, 0) > 0 AND COALESCE(fare_amount, 0) > 0
                AND (pickup_datetime IS NULL OR dropoff_datetime IS NULL)) AS BIGINT) AS enrich_errors
FROM trips"""
    ),
    "fare_category_counts": _w("SELECT fare_category, COUNT(*) AS trips FROM enr GROUP BY fare_category"),
    # what the consumer stream stores: every sent trip, the corrections (their points replace
    # the first ones) and the damaged messages, which are rejected
    "trip_stream_enriched": _w(f"SELECT {_NORM_OUT}, {_ENR_OUT} FROM (SELECT * FROM enr UNION ALL BY NAME SELECT * FROM again)"),
    "trip_points_stored": _w(
        f"""SELECT 'taxi_trips' AS measurement, payment_type, vendor_id, fare_category, pickup_datetime AS time, trip_id,
       passenger_count, {', '.join(f'{expr} AS {name}' for name, expr in _FIELDS[2:])}
FROM (SELECT *, 0 AS turn FROM enr UNION ALL BY NAME SELECT *, 1 AS turn FROM again)
QUALIFY ROW_NUMBER() OVER (PARTITION BY payment_type, vendor_id, fare_category, pickup_datetime ORDER BY turn DESC, trip_id DESC) = 1"""
    ),
    "trip_stream_sample": _w(
        f"""SELECT ordinal, trip_id, pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount, fare_category,
       {hundredths('fpm_h')} AS fare_per_mile, {hundredths('speed_h')} AS speed_mph,
       {hundredths('dur_h')} AS trip_duration_mins
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY turn, pickup_datetime, trip_id) AS ordinal
      FROM (SELECT *, 0 AS turn FROM enr UNION ALL BY NAME SELECT *, 1 AS turn FROM again))
WHERE ordinal <= 5 OR ordinal % 50 = 0"""
    ),
    "trip_pipeline_counts": _w(
        """SELECT enriched + damaged AS consumed, enriched, damaged AS enrich_errors, enriched AS sink_ok, CAST(0 AS BIGINT) AS sink_error,
       (SELECT COUNT(*) FROM (SELECT DISTINCT payment_type, vendor_id, fare_category, pickup_datetime FROM enr) d) AS series_times
FROM (SELECT (SELECT COUNT(*) FROM enr) + (SELECT COUNT(*) FROM again) AS enriched,
             (SELECT COUNT(*) FROM events WHERE event_id % 40 = 0) AS damaged)"""
    ),
}
