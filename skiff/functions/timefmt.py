"""Time text helpers that reproduce how the reference renders times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_TEXT = "yyyy-MM-dd HH:mm:ss"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def python_datetime_text(col: Column | str) -> Column:
    """Text like Python's ``str(datetime)``: microseconds only when non-zero."""
    ts = _c(col)
    return F.when(
        F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, SECOND_TEXT)
    ).otherwise(F.date_format(ts, SECOND_TEXT + ".SSSSSS"))


def epoch_seconds_to_event_time(col: Column | str) -> Column:
    """Epoch seconds (double) → TIMESTAMP truncated to the whole second; NULL for what is
    no time between the years 1 and 9999 (NaN, infinities, other units)."""
    seconds = _c(col).try_cast("bigint")
    return F.when(seconds.between(-62135596800, 253402300799), F.timestamp_seconds(seconds))


def window_key(prefix: str, key: Column | str, start: Column | str) -> Column:
    """``<prefix>:<key>:<start as yyyy-MM-dd HH:mm:ss>``; a NULL key renders 'None'."""
    return F.concat_ws(
        ":",
        F.lit(prefix),
        F.coalesce(_c(key).cast("string"), F.lit("None")),
        F.date_format(_c(start), SECOND_TEXT),
    )
