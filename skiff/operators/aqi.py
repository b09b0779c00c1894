"""Air-quality operators: message build, JSON decode, event time, time windows.

The same ``tumbling`` / ``sliding`` functions serve batch DataFrames and streaming
DataFrames (``withWatermark`` is a no-op in batch), so batch results are the oracle
for the streams. Averages accumulate in DECIMAL: the state kept per window is an
exact sum + count, and the published average is independent of arrival order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from skiff.functions.bands import aqi_band
from skiff.functions.numeric import rounded_quotient
from skiff.functions.timefmt import epoch_seconds_to_event_time

# ---------------------------------------------------------------------------
# The message layout and the reference's stream defaults.
#   tumbling window 30 seconds, watermark 10 seconds, sliding 60 s every 15 s.
#   CSV columns: AQI, state_name, city_ascii, Date, Category, Defining Parameter,
#   lat, lng, population; missing text columns default to 'Unknown' ('' for Date).
# ---------------------------------------------------------------------------
AQI_MESSAGE = StructType(
    [
        StructField("state", StringType()),
        StructField("city", StringType()),
        StructField("date", StringType()),
        StructField("aqi", DoubleType()),
        StructField("category", StringType()),
        StructField("band", StringType()),
        StructField("parameter", StringType()),
        StructField("lat", DoubleType()),
        StructField("lng", DoubleType()),
        StructField("population", DoubleType()),
        StructField("timestamp", DoubleType()),
    ]
)
DEFAULT_TUMBLING = "30 seconds"
DEFAULT_WATERMARK = "10 seconds"
DEFAULT_SLIDING = ("60 seconds", "15 seconds")
_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}
#: DECIMAL form of a measure inside sums: 16 digits before the point, 8 after it.
WIDE_MEASURE = "decimal(24,8)"

_NUMBERS = ("lat", "lng", "population")
REJECT_UNDECODABLE, REJECT_MISSING, REJECT_BAD_VALUE = "undecodable", "missing", "bad_value"


def _text(df: DataFrame, name: str, default: str) -> Column:
    """The column's text trimmed; an empty cell (NULL from the CSV reader) is the empty text, and
    only a column that is not there at all takes the default."""
    return F.coalesce(F.trim(F.col(f"`{name}`")), F.lit("")) if name in df.columns else F.lit(default)


def _number_or_zero(df: DataFrame, name: str) -> Column:
    """Missing column, NULL or empty text → 0.0; other text must parse (else NULL)."""
    if name not in df.columns:
        return F.lit(0.0)
    t = F.trim(F.col(f"`{name}`").cast("string"))
    return F.when(t.isNull() | (t == ""), F.lit(0.0)).otherwise(t.try_cast("double"))


def build_aqi_messages(rows: DataFrame, timestamp: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """CSV-shaped rows → AQI messages.

    AQI must parse as a number; lat/lng/population may be empty (→ 0) but not
    malformed; rows failing either rule are skipped. ``timestamp`` (epoch seconds)
    defaults to the ingestion time. Columns in ``keep`` come along.
    """
    return _messages(rows, timestamp, keep).filter(_message_ok())


def message_counts(rows: DataFrame) -> DataFrame:
    """Producer counters in one pass: rows read, messages sent, rows skipped."""
    ok = _messages(rows, F.lit(0.0)).select(_message_ok().alias("ok"))
    return ok.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if("ok").alias("sent"),
        F.count_if(~F.col("ok")).alias("skipped"),
    )


def _message_ok() -> Column:
    ok = F.col("aqi").isNotNull()
    for name in _NUMBERS:
        ok = ok & F.col(name).isNotNull()
    return ok


def _messages(rows: DataFrame, timestamp: Column | None, keep: Sequence[str] = ()) -> DataFrame:
    aqi = F.trim(F.col("AQI").cast("string")).try_cast("double")
    band = aqi_band(aqi)
    ts = timestamp if timestamp is not None else F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    return rows.select(
        _text(rows, "state_name", "Unknown").alias("state"),
        _text(rows, "city_ascii", "Unknown").alias("city"),
        _text(rows, "Date", "").alias("date"),
        aqi.alias("aqi"),
        (_text(rows, "Category", "") if "Category" in rows.columns else band).alias("category"),
        band.alias("band"),
        _text(rows, "Defining Parameter", "Unknown").alias("parameter"),
        *[_number_or_zero(rows, name).alias(name) for name in _NUMBERS],
        ts.cast("double").alias("timestamp"),
        *keep,
    )


def to_json_value(df: DataFrame) -> DataFrame:
    """Every column serialised into one JSON text column ``value``."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def parse_aqi(raw: DataFrame) -> DataFrame:
    """``value`` (bytes or text JSON) → typed message columns + ``event_time``.

    Malformed JSON decodes to NULL fields (PERMISSIVE) and is removed by the
    non-null AQI filter, as is a message without an AQI.
    """
    decoded = raw.select(F.from_json(F.col("value").cast("string"), AQI_MESSAGE).alias("data"))
    return with_event_time(decoded.select("data.*")).filter(F.col("aqi").isNotNull())


def reject_reason(message: Column, field: str) -> Column:
    """Why ``field`` of a JSON message gave no value: the message is no JSON object, has no
    such key (or null), or holds something that is not of the field's type."""
    keys = F.from_json(message, "map<string,string>")
    return (
        F.when(keys.isNull(), F.lit(REJECT_UNDECODABLE))
        .when(keys[field].isNull(), F.lit(f"{REJECT_MISSING}:{field}"))
        .otherwise(F.lit(f"{REJECT_BAD_VALUE}:{field}"))
    )


def rejected_messages(raw: DataFrame) -> DataFrame:
    """(message, reason) of the messages that no window can take: no AQI or no event time."""
    message = F.col("value").cast("string").alias("message")
    decoded = raw.select(message, F.from_json(message, AQI_MESSAGE).alias("data")).select("message", "data.*")
    bad = with_event_time(decoded).filter(F.col("aqi").isNull() | F.col("event_time").isNull())
    field = F.when(F.col("aqi").isNull(), reject_reason(F.col("message"), "aqi"))
    return bad.select("message", field.otherwise(reject_reason(F.col("message"), "timestamp")).alias("reason"))


def with_event_time(messages: DataFrame) -> DataFrame:
    """Event time = epoch seconds truncated to the whole second (TIMESTAMP)."""
    return messages.withColumn("event_time", epoch_seconds_to_event_time("timestamp"))


def _partial_aggs(measure: str, extremes: bool) -> list[Column]:
    """What a window keeps: an exact DECIMAL sum of the values that fit one, a double sum of the
    rest (NaN, infinities, beyond 16 digits; NULL when there is none), and counts."""
    m = F.col(measure)
    exact = m.try_cast(WIDE_MEASURE)
    aggs = [
        F.sum(exact).alias("_sum"),
        F.sum(F.when(exact.isNull(), m)).alias("_odd"),
        F.count(m).alias("_n"),
        F.count(F.lit(1)).alias("record_count"),
    ]
    if extremes:
        aggs += [F.max(m).alias("_max"), F.min(m).alias("_min")]
    return aggs


_MERGE = {"_sum": F.sum, "_odd": F.sum, "_n": F.sum, "record_count": F.sum, "_max": F.max, "_min": F.min}


def _mean() -> Column:
    """The average to 2 places: exact unless some value has no DECIMAL form, then as doubles
    have it (NaN and infinities included, as in a double average)."""
    exact = rounded_quotient(F.col("_sum"), F.col("_n"), 2).cast("double")
    odd = (F.coalesce(F.col("_sum").cast("double"), F.lit(0.0)) + F.col("_odd")) / F.col("_n")
    return F.when(F.col("_odd").isNull(), exact).otherwise(F.round(odd, 2))


def _finish(agg: DataFrame, key: str, extremes: bool) -> DataFrame:
    cols = [
        F.col(key),
        F.col("win.start").alias("window_start"),
        F.col("win.end").alias("window_end"),
        _mean().alias("avg_aqi"),
    ]
    if extremes:
        cols += [F.round("_max", 2).alias("max_aqi"), F.round("_min", 2).alias("min_aqi")]
    cols += [
        F.col("record_count"),
        F.unix_timestamp(F.col("win.start")).alias("window_ts"),
    ]
    return agg.select(*cols).withColumn("band", aqi_band("avg_aqi"))


def tumbling(
    events: DataFrame,
    duration: str = DEFAULT_TUMBLING,
    key: str = "state",
    measure: str = "aqi",
    time_col: str = "event_time",
    watermark: str | None = None,
) -> DataFrame:
    """Per (tumbling window, key): avg (2 places, exact), max, min, count, band."""
    src = events.withWatermark(time_col, watermark) if watermark else events
    agg = src.groupBy(F.window(time_col, duration).alias("win"), F.col(key)).agg(*_partial_aggs(measure, True))
    return _finish(agg, key, True)


def sliding(
    events: DataFrame,
    duration: str = DEFAULT_SLIDING[0],
    slide: str = DEFAULT_SLIDING[1],
    key: str = "state",
    measure: str = "aqi",
    time_col: str = "event_time",
    watermark: str | None = None,
) -> DataFrame:
    """Per (sliding window, key): avg (2 places, exact), count, band.

    Batch: rows are added up in panes (tumbling windows as wide as the greatest common
    divisor of slide and duration), and only the panes' partial sums are dealt to the
    windows that cover them. A stream in update mode takes one aggregation only, so there
    each row lands in its duration/slide windows before the partial aggregate."""
    if events.isStreaming:
        src = events.withWatermark(time_col, watermark) if watermark else events
        agg = src.groupBy(F.window(time_col, duration, slide).alias("win"), F.col(key)).agg(*_partial_aggs(measure, False))
        return _finish(agg, key, False)
    width, step = seconds_of(duration), seconds_of(slide)
    if not 0 < step <= width:
        raise ValueError("the slide must be positive and no longer than the window")
    pane = math.gcd(width, step)
    panes = events.groupBy(F.window(time_col, f"{pane} seconds").alias("_pane"), F.col(key)).agg(*_partial_aggs(measure, False))
    at = F.unix_timestamp(F.col("_pane.start"))
    newest = at - F.pmod(at, F.lit(step))  # start of the newest window that covers the pane
    starts = F.sequence(newest, at + F.lit(pane - width), F.lit(-step))
    dealt = panes.withColumn("_start", F.explode(starts))
    merged = [_MERGE[c](c).alias(c) for c in ("_sum", "_odd", "_n", "record_count")]
    agg = dealt.groupBy("_start", key).agg(*merged)
    start = F.timestamp_seconds("_start")
    end = F.timestamp_seconds(F.col("_start") + F.lit(width))
    return _finish(agg.withColumn("win", F.struct(start.alias("start"), end.alias("end"))), key, False)


def seconds_of(duration: str) -> int:
    """Whole seconds of an interval text such as '15 minutes'."""
    number, unit = duration.split()
    return int(number) * _SECONDS[unit.rstrip("s")]
