from decimal import Decimal

from pyspark.sql import functions as F

from skiff.operators import clean, quality


def test_normalise_names(spark):
    df = spark.createDataFrame([("a", "b")], "`Order.Date` string, `Sub.Category` string")
    assert clean.normalise_names(df).columns == ["Order_Date", "Sub_Category"]


def test_tolerant_cast_bad_values_become_null(spark):
    vals = ["1.5", "", "x", " 7 ", "3.0", "1e3", "NaN", None]
    df = spark.createDataFrame([(v, v) for v in vals], "Quantity string, Sales string")
    out = clean.tolerant_cast(df, {"Quantity": "int", "Sales": "decimal(18,2)"}).collect()
    assert [r.Quantity for r in out] == [None, None, None, 7, None, None, None, None]
    assert [r.Sales for r in out] == [
        Decimal("1.50"), None, None, Decimal("7.00"), Decimal("3.00"), Decimal("1000.00"), None, None,
    ]


def test_tolerant_date_parse(spark):
    vals = ["2011-01-07 00:00:00.000", "2011-01-07", "bad", None]
    df = spark.createDataFrame([(v,) for v in vals], "Order_Date string")
    out = [r[0] for r in clean.parse_dates(df).collect()]
    assert str(out[0]) == "2011-01-07" and out[1:] == [None, None, None]


def test_midnight_text_parses_as_the_formatter_parses_it(spark):
    midnight = " 00:00:00.000"
    days = ["2011-01-07", "2012-02-29", "2011-02-29", "2011-13-01", "2011-00-10", "2011-01-00", "0001-01-01", "0000-01-01", "9999-12-31",
            "1582-10-10", "2011-01-7 ", "2011-01-1T", "2011-01- 7", " 011-01-07", "-011-01-07", "+011-01-07", "2011-1-007", "2011/01/07",
            "2011-01-0x", "2011-0a-07", "20é1-01-07", "2011-01-1:", "          ", "12011-01-07", "+12011-01-07", "2011-01"]
    texts = [d + midnight for d in days] + ["2011-01-07 00:00:00.001", "2011-01-07 23:59:59.999", "2011-01-07 00:00:00", "", midnight, None]
    df = spark.createDataFrame([(t,) for t in texts], "Order_Date string")
    day = F.try_to_date("Order_Date", clean.ORDER_DATE_FORMAT).cast("string")
    assert clean.parse_dates(df).select(F.col("Order_Date").cast("string")).collect() == df.select(day).collect()
    # valid days at midnight never reach the formatter
    plain = df.select(day.alias("d"), clean._midnight(F.col("Order_Date")).cast("string").alias("m"))
    assert plain.filter("m is not null and not m <=> d").isEmpty()
    assert plain.filter("m is not null").count() == 6


def test_cleaning_rule_nan_and_nulls(spark):
    df = spark.createDataFrame(
        [
            (10.0, 1.0, "2011-01-07", "A", "R"),
            (float("nan"), 1.0, "2011-01-07", "A", "R"),  # NaN > 0 is TRUE in Spark
            (-1.0, 1.0, "2011-01-07", "A", "R"),
            (0.0, 1.0, "2011-01-07", "A", "R"),
            (5.0, None, "2011-01-07", "A", "R"),
            (5.0, 1.0, None, "A", "R"),
            (5.0, 1.0, "2011-01-07", None, "R"),
            (5.0, 1.0, "2011-01-07", "A", None),
        ],
        "Sales double, Profit double, Order_Date string, Category string, Region string",
    )
    assert clean.clean_order_lines(df).count() == 1
    s = quality.cleaning_summary(df).first()
    assert (s.rows_before, s.rows_after, s.removed) == (8, 1, 7)


def test_profit_margin_half_up_and_zero_sales(spark):
    df = spark.createDataFrame(
        [(Decimal("3.00"), Decimal("1.00")), (Decimal("8.00"), Decimal("-1.00"))],
        "Sales decimal(18,2), Profit decimal(18,2)",
    ).withColumn("Order_Date", F.lit(None).cast("date"))
    out = clean.derive_order_measures(df).collect()
    assert [r.Profit_Margin for r in out] == [Decimal("33.33"), Decimal("-12.50")]


def test_schema_report_and_describe(spark):
    df = spark.createDataFrame([(1, Decimal("1.00")), (2, Decimal("2.00")), (4, None)], "Quantity int, Sales decimal(18,2)")
    rep = {r.column: r.type for r in quality.schema_report(df).collect()}
    assert rep == {"Quantity": "int", "Sales": "decimal(18,2)"}
    d = {r.column_name: r for r in quality.describe_numeric(df, ["Quantity", "Sales"]).collect()}
    assert d["Quantity"].n == 3 and d["Quantity"].mean == 2.3333 and d["Quantity"].max_value == 4.0
    assert d["Sales"].n == 2 and d["Sales"].mean == 1.5 and d["Sales"].stddev == 0.7071


def test_whole_report_from_one_scan(spark):
    raw = spark.createDataFrame(
        [("1", "2011-01-07 00:00:00.000", "A", "X", "N", "10.004999", "1.5", "2", "0.1"),
         ("2", "bad", "A", "X", None, "0.004", "-1", "3", "0"),
         ("3", "2011-01-08 00:00:00.000", "B", "Y", "S", "n/a", "1", "x", None),
         ("4", None, "B", "Y", "S", "-5", "1", "4", "0.25"),
         ("5", "2011-01-09 00:00:00.000", "B", None, "S", "0.004", "1", "4", "0.25")],
        "`Order.ID` string, `Order.Date` string, Category string, Segment string, Region string, Sales string, Profit string, "
        "Quantity string, Discount string")
    rows, kept = quality.report_rows(raw)
    groups = quality.report_groups(rows, kept)
    assert groups._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    parts = quality.report_from_groups(groups, rows.schema)
    typed = clean.type_order_lines(raw)
    assert parts["row_count"].first()[0] == 5
    nulls = parts["null_counts"].first().asDict()
    assert nulls["Order_Date"] == 1 and nulls["Sales"] == 1 and nulls["Region"] == 1  # 'bad' is a text, not a NULL
    assert {(r.column, r.type, r.non_null) for r in parts["schema"].collect()} >= {("Order_Date", "string", 4), ("Sales", "decimal(18,6)", 4)}
    as_rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert as_rows(parts["value_counts"]) == as_rows(quality.value_counts(typed))
    assert as_rows(parts["describe"]) == as_rows(quality.describe_numeric(typed))
    assert as_rows(parts["cleaning_summary"]) == as_rows(quality.cleaning_summary(typed)) == [(5, 2, 3)]


def test_fine_digits_survive_the_load(spark):
    """A price below half a cent is a sale, and nothing is rounded before it is summed."""
    raw = spark.createDataFrame([("0.004", "0.001")] * 1000 + [("999.996", "1")] + [("10.0049", "1")] * 1000, "Sales string, Profit string")
    raw = raw.selectExpr("Sales", "Profit", "'2011-01-07 00:00:00.000' AS `Order.Date`", "'A' AS Category", "'R' AS Region")
    lines = clean.load_clean(raw)
    total = lines.agg(F.sum("Sales").alias("s"), F.count(F.lit(1)).alias("n")).first()
    assert total.n == 2001 and total.s == Decimal("4") + Decimal("999.996") + Decimal("10004.9")
    assert {r.Sales_Band for r in lines.filter("Sales > 900").collect()} == {"Medium"}
    assert {r.Profit_Margin for r in lines.filter("Sales < 1").collect()} == {Decimal("25.00")}


def test_value_counts_one_pass(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "Category string, Region string")
    got = {(r.column_name, r.value, r.n) for r in quality.value_counts(df, ["Category", "Region"]).collect()}
    assert got == {("Category", "a", 2), ("Category", "b", 1), ("Region", "x", 2), ("Region", None, 1)}


def test_null_counts_query_counts_dates_that_do_not_parse(spark, tmp_dir):
    from skiff.plans.retail import q_null_counts
    from skiff.sources import fixtures

    root = f"{tmp_dir}/tables"
    raw = spark.createDataFrame(
        [("2011-01-07 00:00:00.000", "soon", "1.5"), ("bad", "2011-01-07 00:00:00.000", "n/a"), (None, "2011-01-07 00:00:00.000", "1")],
        "`Order.Date` string, `Ship.Date` string, Sales string")
    raw.write.parquet(f"{tmp_dir}/raw")
    fixtures._STORED[(spark.sparkContext.applicationId, root, "order_lines_raw")] = f"{tmp_dir}/raw"
    assert q_null_counts(spark, root).first().asDict() == {"Order_Date": 2, "Ship_Date": 1, "Sales": 1}
