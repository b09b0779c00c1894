"""Threshold bands as native ``CASE WHEN`` chains (one helper for every band in the library)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Thresholds and labels that must equal the reference's
# classifications exactly (order: first matching rule wins).
#
# Sales band, rule "value >= threshold":
#   1000 -> High, 300 -> Medium, otherwise Low
# Fare category, rule "value < threshold":
#   10 -> Low, 25 -> Medium, 50 -> High, otherwise Premium
# AQI band, rule "value <= threshold":
#   50 -> Good, 100 -> Moderate, 150 -> Unhealthy for Sensitive Groups,
#   200 -> Unhealthy, 300 -> Very Unhealthy, otherwise Hazardous
# ---------------------------------------------------------------------------
SALES_BANDS: tuple[tuple[float, str], ...] = ((1000, "High"), (300, "Medium"))
SALES_BAND_DEFAULT = "Low"

FARE_CATEGORIES: tuple[tuple[float, str], ...] = ((10, "Low"), (25, "Medium"), (50, "High"))
FARE_CATEGORY_DEFAULT = "Premium"

AQI_BANDS: tuple[tuple[float, str], ...] = (
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
)
AQI_BAND_DEFAULT = "Hazardous"

# Severity order used to break ties between bands (mildest first).
AQI_SEVERITY: tuple[str, ...] = tuple(label for _, label in AQI_BANDS) + (AQI_BAND_DEFAULT,)

_COMPARE = {
    "ge": lambda c, t: c >= t,
    "gt": lambda c, t: c > t,
    "le": lambda c, t: c <= t,
    "lt": lambda c, t: c < t,
}


def band(
    col: Column | str,
    rules: Sequence[tuple[float, str]],
    default: str,
    side: str,
) -> Column:
    """``CASE WHEN col <side> t1 THEN l1 ... ELSE default END``; NULL input stays NULL.

    NaN follows Spark ordering (NaN is greater than every number): it fails every
    ``le``/``lt`` rule and lands in ``default``.
    """
    c = F.col(col) if isinstance(col, str) else col
    cmp = _COMPARE[side]
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for threshold, label in rules:
        expr = expr.when(cmp(c, F.lit(threshold)), F.lit(label))
    return expr.otherwise(F.lit(default))


def sales_band(col: Column | str) -> Column:
    return band(col, SALES_BANDS, SALES_BAND_DEFAULT, "ge")


def fare_category(col: Column | str) -> Column:
    return band(col, FARE_CATEGORIES, FARE_CATEGORY_DEFAULT, "lt")


def aqi_band(col: Column | str) -> Column:
    return band(col, AQI_BANDS, AQI_BAND_DEFAULT, "le")


def aqi_severity(col: Column | str) -> Column:
    """1-based severity rank of an AQI band label (for deterministic tie-breaks)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_position(F.array(*[F.lit(b) for b in AQI_SEVERITY]), c)
