from decimal import Decimal

from skiff.operators import windows


def test_yoy_skips_missing_year_and_zero_previous(spark):
    rows = [
        ("A", 2011, Decimal("100.00")),
        ("A", 2013, Decimal("150.00")),  # 2012 missing: compared with 2011
        ("B", 2011, Decimal("0.00")),
        ("B", 2012, Decimal("10.00")),  # previous 0 → NULL growth
        ("C", 2014, Decimal("5.00")),  # single year
    ]
    df = windows_input(spark, rows)
    out = {(r.Category, r.Year): r for r in windows.yoy_growth(df).collect()}
    assert out[("A", 2011)].YoY_Growth_Pct is None
    assert out[("A", 2013)].Prev_Year_Sales == Decimal("100.00") and out[("A", 2013)].YoY_Growth_Pct == Decimal("50.00")
    assert out[("B", 2012)].YoY_Growth_Pct is None
    assert out[("C", 2014)].YoY_Growth_Pct is None
    cum = {(r.Category, r.Year): r.Cumulative_Revenue for r in windows.cumulative_revenue(df).collect()}
    assert cum[("A", 2013)] == Decimal("250.00")


def windows_input(spark, rows):
    return spark.createDataFrame(rows, "Category string, Year int, Sales decimal(18,2)")


def test_latest_per_key_with_tiebreak(spark):
    df = spark.createDataFrame(
        [("s", 1, "old"), ("s", 3, "new"), ("t", 2, "a"), ("t", 2, "b")], "k string, ts int, v string"
    )
    out = {r.k: r.v for r in windows.latest_per_key(df, ["k"], ["ts", "v"], ["v"]).collect()}
    assert out == {"s": "new", "t": "b"}
