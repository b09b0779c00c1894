"""DuckDB twins of the air-quality contract queries.

Windows are computed with epoch-second arithmetic (Spark aligns windows to the
epoch): tumbling start = s - s % 3600; a sliding 1 h / 15 min window set for s is
floor900(s) - 900*k for k = 0..3.
"""

from __future__ import annotations

from skiff.plans.oracle_retail import half_up, hundredths
from skiff.plans.aqi import KEPT_DAYS
from skiff.sources.fixtures import AQI_SLICES, DAMAGED_AQI, DAMAGED_TRIPS, LATE_SLICES


def _band(h: str, unit: int = 1) -> str:
    """AQI band of a value given in integer hundredths (times ``unit``)."""
    return (
        f"CASE WHEN {h} <= {5000 * unit} THEN 'Good' WHEN {h} <= {10000 * unit} THEN 'Moderate'"
        f" WHEN {h} <= {15000 * unit} THEN 'Unhealthy for Sensitive Groups' WHEN {h} <= {20000 * unit} THEN 'Unhealthy'"
        f" WHEN {h} <= {30000 * unit} THEN 'Very Unhealthy' ELSE 'Hazardous' END"
    )


def _ts(sec: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({sec}))"


_TEXT = "'%Y-%m-%d %H:%M:%S'"

def _micro(x: str) -> str:
    """A double with at most 6 decimals as integer millionths."""
    return f"CAST(ROUND({x} * 1000000) AS BIGINT)"


def _cut(x: str) -> str:
    """Millionths rounded half up to hundredths."""
    return half_up(x, "10000")


def _windows(name: str, rows: str) -> str:
    """Tumbling windows over ``rows`` (state, aqi, es)."""
    return f"""{name}_w AS (
  SELECT state, es - es % 3600 AS ws, COUNT(*) AS record_count, CAST(SUM({_micro('aqi')}) AS BIGINT) AS s_m, COUNT(aqi) AS n,
         MAX({_micro('aqi')}) AS mx, MIN({_micro('aqi')}) AS mn
  FROM {rows} GROUP BY state, es - es % 3600
),
{name} AS (
  SELECT state, {_ts('ws')} AS window_start, {_ts('ws + 3600')} AS window_end,
         {half_up('s_m', 'n * 10000')} AS avg_h, {hundredths(_cut('mx'))} AS max_aqi, {hundredths(_cut('mn'))} AS min_aqi,
         record_count, ws AS window_ts
  FROM {name}_w
)"""


def _emissions(name: str, rows: str) -> str:
    """Every (window, batch) that got rows of ``rows`` (state, aqi, es, batch), with what the
    window held after that batch."""
    return f"""{name}_b AS (
  SELECT state, es - es % 3600 AS ws, batch, COUNT(*) AS c, CAST(SUM({_micro('aqi')}) AS BIGINT) AS s_m
  FROM {rows} GROUP BY ALL
),
{name} AS (
  SELECT state, ws, batch, c AS added, CAST(SUM(c) OVER w AS BIGINT) AS record_count,
         {half_up('CAST(SUM(s_m) OVER w AS BIGINT)', 'CAST(SUM(c) OVER w AS BIGINT) * 10000')} AS avg_h
  FROM {name}_b WINDOW w AS (PARTITION BY state, ws ORDER BY batch)
)"""


CTES = f"""
msg AS (
  SELECT event_type AS state, event_id, CAST(CAST(value AS DECIMAL(10,2)) + (event_id % 1000) * 0.000001 AS DOUBLE) AS aqi,
         CAST(floor(epoch(ts)) AS BIGINT) AS es FROM events
),
span AS (SELECT MIN(es) AS lo, MAX(es) AS hi FROM msg),
{_windows('tumb', 'msg')},
sx AS (
  SELECT state, aqi, (es - es % 900) - 900 * k AS ws
  FROM (SELECT state, aqi, es, unnest([0, 1, 2, 3]) AS k FROM msg) e
),
sw AS (
  SELECT state, ws, COUNT(*) AS record_count, CAST(SUM({_micro('aqi')}) AS BIGINT) AS s_m, COUNT(aqi) AS n
  FROM sx GROUP BY state, ws
),
slid AS (
  SELECT state, {_ts('ws')} AS window_start, {_ts('ws + 3600')} AS window_end,
         {half_up('s_m', 'n * 10000')} AS avg_h, record_count, ws AS window_ts
  FROM sw
),
tumb_bands AS (
  SELECT {_band('avg_h')} AS band, CAST(SUM(record_count) AS BIGINT) AS count FROM tumb GROUP BY 1
),
paced AS (SELECT state, aqi, es, (es - lo) * {AQI_SLICES} // (hi - lo + 1) AS batch FROM msg, span),
{_emissions('emission', 'paced')},
bands AS (
  SELECT {_band('avg_h')} AS band, CAST(SUM(record_count) AS BIGINT) AS count FROM emission GROUP BY 1
),
arrival AS (
  SELECT state, aqi, es, LEAST((es - lo) * {LATE_SLICES} // (hi - lo + 1)
                               + CASE WHEN event_id % 7 = 0 THEN 1 WHEN event_id % 11 = 0 THEN 2 ELSE 0 END, {LATE_SLICES - 1}) AS batch
  FROM msg, span
),
seen AS (SELECT batch, MAX(es) AS es FROM arrival GROUP BY batch),
late AS (
  SELECT a.*, es - es % 3600 + 3600 <= COALESCE((SELECT MAX(s.es) FROM seen s WHERE s.batch <= a.batch - 2) - 600, -1) AS dropped
  FROM arrival a
),
on_time AS (SELECT * FROM late WHERE NOT dropped),
{_windows('late_tumb', 'on_time')},
{_emissions('late_emission', 'on_time')}"""


def _w(body: str) -> str:
    return f"WITH {CTES}\n{body}"


_TUMB_OUT = f"""state, window_start, window_end, {hundredths('avg_h')} AS avg_aqi, max_aqi, min_aqi,
       record_count, window_ts, {_band('avg_h')} AS band"""
_SLID_OUT = f"""state, window_start, window_end, {hundredths('avg_h')} AS avg_aqi, record_count, window_ts,
       {_band('avg_h')} AS band"""

ORACLES = {
    "aqi_parsed": _w(
        f"""SELECT state, 'user-' || CAST(e.user_id AS VARCHAR) AS city, aqi, {_band(_micro('aqi'), 10_000)} AS band,
       {_ts('es')} AS event_time
FROM msg JOIN events e USING (event_id)"""
    ),
    "aqi_message_counts": """SELECT COUNT(*) AS rows_read, CAST(COUNT_IF(value IS NOT NULL) AS BIGINT) AS sent,
       CAST(COUNT_IF(value IS NULL) AS BIGINT) AS skipped FROM events""",
    "aqi_tumbling_batch": _w(f"SELECT {_TUMB_OUT} FROM tumb"),
    "aqi_sliding_batch": _w(f"SELECT {_SLID_OUT} FROM slid"),
    "aqi_window_results": _w(
        f"""SELECT state, strftime(window_start, {_TEXT}) AS window_start, {hundredths('avg_h')} AS avg_aqi,
       max_aqi, min_aqi, record_count, {_band('avg_h')} AS band FROM tumb"""
    ),
    "aqi_sliding_results": _w(
        f"""SELECT state, strftime(window_start, {_TEXT}) AS window_start, {hundredths('avg_h')} AS avg_aqi,
       record_count, {_band('avg_h')} AS band FROM slid"""
    ),
    "band_counts_exact": _w("SELECT band, count FROM tumb_bands"),
    "band_distribution": _w(
        f"""SELECT band, count,
       {hundredths(half_up('count * 10000', '(SELECT SUM(count) FROM bands)'))} AS share_pct
FROM bands ORDER BY count DESC, band"""
    ),
    "dominant_band": _w(
        """SELECT band, count FROM bands
ORDER BY count DESC, list_position(['Good', 'Moderate', 'Unhealthy for Sensitive Groups', 'Unhealthy',
                                    'Very Unhealthy', 'Hazardous'], band) DESC
LIMIT 1"""
    ),
    "live_kpis": _w(
        f"""SELECT CAST(SUM(record_count) AS BIGINT) AS total_records,
       {hundredths(half_up('SUM(avg_h)', 'COUNT(*)'))} AS global_avg_aqi,
       MAX(max_aqi) AS peak_aqi, COUNT(*) AS active_windows FROM tumb"""
    ),
    "latest_per_state": _w(
        f"""SELECT state, window_start, {hundredths('avg_h')} AS avg_aqi, {_band('avg_h')} AS band
FROM tumb QUALIFY ROW_NUMBER() OVER (PARTITION BY state ORDER BY window_start DESC) = 1"""
    ),
    "latest_500_windows": _w(
        f"""SELECT 'window:' || state || ':' || strftime(window_start, {_TEXT}) AS key, window_ts FROM tumb
ORDER BY window_ts DESC, key DESC LIMIT 500"""
    ),
    "recent_feed": _w(
        f"""SELECT state, {hundredths('avg_h')} AS avg_aqi, {_band('avg_h')} AS band,
       strftime(window_start, {_TEXT}) AS window, record_count AS count
FROM tumb ORDER BY window_ts DESC, state DESC LIMIT 10"""
    ),
    "timeline_50": _w(
        f"""SELECT * FROM (SELECT window_start, state, {hundredths('avg_h')} AS avg_aqi FROM tumb
ORDER BY window_start DESC, state DESC LIMIT 50) t ORDER BY window_start, state"""
    ),
    "newest_windows": _w(
        f"""SELECT state, window_start, {hundredths('avg_h')} AS avg_aqi, max_aqi, record_count,
       {_band('avg_h')} AS band FROM tumb ORDER BY window_start DESC, state DESC LIMIT 20"""
    ),
    "compare_windows": _w(
        f"""SELECT t.state, {hundredths('t.avg_h')} AS tumbling_avg_aqi, {hundredths('s.avg_h')} AS sliding_avg_aqi
FROM (SELECT * FROM tumb QUALIFY ROW_NUMBER() OVER (PARTITION BY state ORDER BY window_start DESC) = 1) t
JOIN (SELECT * FROM slid QUALIFY ROW_NUMBER() OVER (PARTITION BY state ORDER BY window_start DESC) = 1) s
  ON t.state = s.state
ORDER BY t.state LIMIT 15"""
    ),
    "common_states": _w("SELECT state FROM tumb INTERSECT SELECT state FROM slid"),
}
ORACLES["aqi_tumbling_stream"] = ORACLES["aqi_tumbling_batch"]
ORACLES["aqi_sliding_stream"] = ORACLES["aqi_sliding_batch"]
ORACLES["band_counts_emitted"] = _w("SELECT band, count FROM bands")
ORACLES["latest_500_sliding"] = _w(
    f"""SELECT 'sliding:' || state || ':' || strftime(window_start, {_TEXT}) AS key, window_ts FROM slid
ORDER BY window_ts DESC, key DESC LIMIT 500"""
)
ORACLES["aqi_unexpired_windows"] = _w(
    f"""SELECT state, window_start, {hundredths('avg_h')} AS avg_aqi, record_count, {_band('avg_h')} AS band FROM tumb
WHERE window_ts + 3600 > (SELECT MAX(window_ts) FROM tumb)"""
)
ORACLES["aqi_late_rows"] = _w(
    """SELECT batch AS batch_id, COUNT(*) AS rows_in, CAST(COUNT_IF(NOT dropped) AS BIGINT) AS rows_added,
       CAST(COUNT_IF(dropped) AS BIGINT) AS rows_dropped,
       COUNT(DISTINCT CASE WHEN dropped THEN (state, es - es % 3600) END) AS groups_dropped
FROM late GROUP BY batch"""
)
ORACLES["aqi_late_windows"] = _w(
    f"""SELECT state, window_start, {hundredths('avg_h')} AS avg_aqi, max_aqi, min_aqi, record_count, {_band('avg_h')} AS band
FROM late_tumb WHERE CAST(window_start AS DATE) > (SELECT MAX(CAST(window_start AS DATE)) FROM late_tumb) - {KEPT_DAYS}"""
)
ORACLES["aqi_late_band_counts"] = _w(
    f"SELECT {_band('avg_h')} AS band, CAST(SUM(record_count) AS BIGINT) AS count FROM late_emission GROUP BY 1"
)


def _texts(templates, ids: str, time: str) -> str:
    """The damaged message of an event: its kind's template with the event's values."""
    filled = ", ".join("replace(replace(replace(" + "'" + t.replace("'", "''") + f"', '#', CAST(event_id AS VARCHAR)), '@', {time}), '$', event_type)"
                       for t in templates)
    return f"[{filled}][{ids}]"


_AQI_REASONS = ("undecodable", "missing:aqi", "bad_value:aqi", "bad_value:timestamp", "bad_value:timestamp", "bad_value:timestamp",
                "missing:timestamp")
_TRIP_REASONS = ("undecodable", "bad_value:trip_distance", "bad_value:tip_amount", "bad_value:fare_amount", "missing:fare_amount",
                 "bad_value:pickup_datetime", "zero_distance", "undecodable")


def _rejects(templates, reasons, every: int, time: str) -> str:
    kind = f"event_id // {every} % {len(templates)} + 1"
    return f"""SELECT {_texts(templates, kind, time)} AS message, {list(reasons)}[{kind}] AS reason
FROM events WHERE event_id % {every} = 0"""


ORACLES["aqi_stream_rejects"] = _rejects(DAMAGED_AQI, _AQI_REASONS, 50, "CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)")
ORACLES["trip_stream_rejects"] = _rejects(DAMAGED_TRIPS, _TRIP_REASONS, 40, f"strftime(ts, {_TEXT})")
