from pyspark.sql import functions as F

from skiff.functions.bands import aqi_band, fare_category, sales_band


def _apply(spark, fn, values, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_fare_category_boundaries(spark):
    vals = [9.99, 10.0, 24.99, 25.0, 49.99, 50.0, -1.0, float("nan"), None]
    assert _apply(spark, fare_category, vals) == [
        "Low", "Medium", "Medium", "High", "High", "Premium", "Low", "Premium", None,
    ]


def test_sales_band_boundaries(spark):
    vals = [0.0, -5.0, 299.99, 300.0, 999.99, 1000.0, None]
    assert _apply(spark, sales_band, vals) == ["Low", "Low", "Low", "Medium", "Medium", "High", None]


def test_sales_band_on_decimal(spark):
    from decimal import Decimal

    vals = [None, Decimal("300.00"), Decimal("1000.00")]
    assert _apply(spark, sales_band, vals, "decimal(18,2)") == [None, "Medium", "High"]


def test_aqi_band_boundaries(spark):
    vals = [50.0, 50.01, 100.0, 150.0, 200.0, 300.0, 300.01, float("nan"), None]
    assert _apply(spark, aqi_band, vals) == [
        "Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
        "Very Unhealthy", "Hazardous", "Hazardous", None,
    ]


def test_aqi_band_of_rounded_average(spark):
    # 50.004 rounds to 50.00 first, so the band is Good
    df = spark.createDataFrame([(50.004,)], "x double")
    assert df.select(aqi_band(F.round("x", 2))).first()[0] == "Good"


def _python_band(x, rules, default, side):
    if x is None:
        return None
    for threshold, label in rules:
        if {"ge": x >= threshold, "lt": x < threshold, "le": x <= threshold}[side]:
            return label
    return default


def test_bands_match_their_rule_on_random_values(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from skiff.functions import bands as B

    cases = (
        (sales_band, B.SALES_BANDS, B.SALES_BAND_DEFAULT, "ge"),
        (fare_category, B.FARE_CATEGORIES, B.FARE_CATEGORY_DEFAULT, "lt"),
        (aqi_band, B.AQI_BANDS, B.AQI_BAND_DEFAULT, "le"),
    )
    values = st.lists(st.one_of(st.none(), st.floats(-100, 2000, allow_nan=False)), min_size=1, max_size=100)

    @settings(max_examples=5, deadline=None)
    @given(values)
    def check(xs):
        for fn, rules, default, side in cases:
            assert _apply(spark, fn, xs) == [_python_band(x, rules, default, side) for x in xs]

    check()
