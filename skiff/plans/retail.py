"""Contract queries of the retail batch flow: raw order lines → clean → marts → serving."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiff.operators import analysis, clean, marts, quality, serve, windows
from skiff.plans.output import edge
from skiff.session import apply_defaults, new_run_dir
from skiff.sinks import tables
from skiff.sources.files import read_raw_csv, write_raw_csv
from skiff.sources.fixtures import order_lines_raw, order_lines_raw_parts, stored

# Dashboard selections used by the contract (the feature's own parameters).
SELECTED_YEARS = (1996, 1998, 2000)
EMPTY_YEAR = 1900
SELECTED_CATEGORY = "LARGE"


def typed_lines(spark: SparkSession, root: str) -> DataFrame:
    apply_defaults(spark)
    return clean.type_order_lines(stored(spark, root, "order_lines_raw"))


def clean_lines(spark: SparkSession, root: str) -> DataFrame:
    return clean.derive_order_measures(clean.clean_order_lines(typed_lines(spark, root)))


def derived_clean_lines(spark: SparkSession, root: str) -> DataFrame:
    """``clean_lines`` straight from the tables: for readers of a few columns. Only what they
    need goes through the joins, and the raw lines are not written out first."""
    apply_defaults(spark)
    return clean.load_clean(order_lines_raw(spark, root))


#: What the marts and the analysis questions read of a cleaned line.
ANALYSED = ("Category", "Sub_Category", "Region", "Order_Date", "Year", "Sales", "Profit", "Profit_Margin")


def cleaned(spark: SparkSession, root: str) -> DataFrame:
    """The cleaned order lines as the batch flow keeps them for analysis: cleaned once per
    application, written to the shared folder, read back (typed parquet) by every
    analysis query. Filters and projections of the readers reach this scan."""
    apply_defaults(spark)
    return stored(spark, root, "order_lines_clean", lambda s, r: derived_clean_lines(s, r).select(*ANALYSED))


_CSV: dict[tuple[str, str], str] = {}
_DATABASES: dict[tuple[str, str], str] = {}


def published_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four marts as published: built from one scan of the cleaned lines, loaded into
    tables of a catalog database (once per application and input) and read back from there."""
    key = (spark.sparkContext.applicationId, root.rstrip("/"))
    database = _DATABASES.get(key)
    if database is None:
        database = f"skiff_marts_{uuid.uuid4().hex[:12]}"
        tables.setup_namespace(spark, database, new_run_dir(spark, database), select=False)
        tables.swap_marts(marts.build_marts(cleaned(spark, root)), database)
        _DATABASES[key] = database
    return {name: spark.table(f"{database}.{name}") for name in marts.MART_NAMES}


def quality_report(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All parts of the data-quality report over the raw lines, from one scan of them."""
    apply_defaults(spark)
    raw = stored(spark, root, "order_lines_raw")
    rows, kept = quality.report_rows(raw)
    groups = stored(spark, root, "quality_groups", lambda s, r: quality.report_groups(rows, kept))
    return quality.report_from_groups(groups, rows.schema)


def q_clean_orders(spark, root):
    return edge(clean_lines(spark, root))


def q_csv_clean_orders(spark, root):
    """The cleaned lines from CSV files, read schema-on-read as the reference reads its input."""
    apply_defaults(spark)
    key = (spark.sparkContext.applicationId, root.rstrip("/"))
    if key not in _CSV:
        folder = new_run_dir(spark, "order-lines-csv")
        write_raw_csv(order_lines_raw_parts(spark, root), folder)
        _CSV[key] = folder
    return edge(clean.load_clean(read_raw_csv(spark, _CSV[key])))


def q_tolerant_cast(spark, root):
    return edge(
        typed_lines(spark, root).select(
            "Order_ID", "Line_No", "Order_Date", "Sales", "Profit", "Quantity", "Discount", "Shipping_Cost"
        )
    )


def q_profit_margin(spark, root):
    return edge(derived_clean_lines(spark, root).select("Order_ID", "Line_No", "Sales", "Profit", "Profit_Margin"))


def q_sales_band_counts(spark, root):
    return (
        clean_lines(spark, root)
        .groupBy("Sales_Band")
        .agg(F.count(F.lit(1)).alias("LINE_COUNT"))
        .orderBy(F.desc("LINE_COUNT"))
    )


def q_order_line_count(spark, root):
    return quality_report(spark, root)["row_count"]


def q_category_sales(spark, root):
    return edge(analysis.category_revenue(cleaned(spark, root)))


def q_region_performance(spark, root):
    return edge(analysis.region_order_value(cleaned(spark, root)))


def q_yearly_revenue(spark, root):
    return edge(analysis.yearly_revenue_trend(cleaned(spark, root)))


def q_yearly_revenue_sql(spark, root):
    return edge(marts.yearly_revenue_sql(spark, cleaned(spark, root)))


def q_subcategory_profit_sql(spark, root):
    return edge(marts.subcategory_profit_sql(spark, cleaned(spark, root)))


def q_subcategory_losses(spark, root):
    return edge(marts.subcategory_profit_sql(spark, cleaned(spark, root), losses_only=True))


def q_least_profitable_top20(spark, root):
    """The analysis display: first 20 sub-categories by profit, ascending."""
    return edge(marts.subcategory_profit_sql(spark, cleaned(spark, root)).limit(20))


def q_subcategory_rank_top30(spark, root):
    """The ranking display: first 30 rows by category, rank (ties by sub-category)."""
    return edge(windows.rank_subcategories(cleaned(spark, root)).limit(30))


def q_subcategory_rank(spark, root):
    return edge(windows.rank_subcategories(cleaned(spark, root)))


def q_cumulative_revenue(spark, root):
    return edge(windows.cumulative_revenue(cleaned(spark, root)))


def q_yoy_growth(spark, root):
    return edge(windows.yoy_growth(cleaned(spark, root)))


def q_null_counts(spark, root):
    """NULLs per column of the typed lines: text that is no number or no date counts as NULL
    (the report's own part, as the reference prints it, has the dates still as text)."""
    return quality.null_counts(typed_lines(spark, root))


def q_value_counts(spark, root):
    return quality_report(spark, root)["value_counts"]


def q_describe_numeric(spark, root):
    return quality_report(spark, root)["describe"]


def q_schema_report(spark, root):
    return quality_report(spark, root)["schema"]


def q_cleaning_summary(spark, root):
    return quality_report(spark, root)["cleaning_summary"]


def q_mart_category_sales(spark, root):
    return edge(published_marts(spark, root)["CATEGORY_SALES"])


def q_mart_subcategory_rank(spark, root):
    return edge(published_marts(spark, root)["SUBCATEGORY_RANK"])


def q_mart_yearly_revenue(spark, root):
    return edge(published_marts(spark, root)["YEARLY_REVENUE"])


def q_mart_region_performance(spark, root):
    return edge(published_marts(spark, root)["REGION_PERFORMANCE"])


def q_profit_efficiency(spark, root):
    return edge(serve.profit_efficiency(published_marts(spark, root)["CATEGORY_SALES"]))


def q_revenue_per_order(spark, root):
    return edge(serve.revenue_per_order(published_marts(spark, root)["YEARLY_REVENUE"]))


def q_kpi_yearly(spark, root):
    return edge(serve.kpi_yearly(published_marts(spark, root)["YEARLY_REVENUE"], years=None))


def q_kpi_category(spark, root):
    return edge(serve.kpi_category(published_marts(spark, root)["CATEGORY_SALES"], category=None))


def q_kpi_yearly_selected(spark, root):
    return edge(serve.kpi_yearly(published_marts(spark, root)["YEARLY_REVENUE"], years=SELECTED_YEARS))


def q_kpi_yearly_none(spark, root):
    """A year without data: every KPI is 0."""
    return edge(serve.kpi_yearly(published_marts(spark, root)["YEARLY_REVENUE"], years=(EMPTY_YEAR,)))


def q_kpi_category_selected(spark, root):
    return edge(serve.kpi_category(published_marts(spark, root)["CATEGORY_SALES"], category=SELECTED_CATEGORY))


def q_top_subcategories_selected(spark, root):
    return edge(serve.top_subcategories(published_marts(spark, root)["SUBCATEGORY_RANK"], category=SELECTED_CATEGORY, n=10))


def q_top_subcategories(spark, root):
    return edge(serve.top_subcategories(published_marts(spark, root)["SUBCATEGORY_RANK"], category=None, n=10))


def q_yearly_trend_selected(spark, root):
    return edge(serve.yearly_trend(published_marts(spark, root)["YEARLY_REVENUE"], years=SELECTED_YEARS))


def q_category_totals(spark, root):
    return edge(serve.category_totals(published_marts(spark, root)["CATEGORY_SALES"]))


def q_region_table(spark, root):
    return edge(serve.region_table(published_marts(spark, root)["REGION_PERFORMANCE"]))


QUERIES = {
    "clean_orders": q_clean_orders,
    "csv_clean_orders": q_csv_clean_orders,
    "tolerant_cast": q_tolerant_cast,
    "profit_margin": q_profit_margin,
    "sales_band_counts": q_sales_band_counts,
    "order_line_count": q_order_line_count,
    "category_sales": q_category_sales,
    "region_performance": q_region_performance,
    "yearly_revenue": q_yearly_revenue,
    "yearly_revenue_sql": q_yearly_revenue_sql,
    "subcategory_profit_sql": q_subcategory_profit_sql,
    "subcategory_losses": q_subcategory_losses,
    "subcategory_rank": q_subcategory_rank,
    "least_profitable_top20": q_least_profitable_top20,
    "subcategory_rank_top30": q_subcategory_rank_top30,
    "cumulative_revenue": q_cumulative_revenue,
    "yoy_growth": q_yoy_growth,
    "null_counts": q_null_counts,
    "value_counts": q_value_counts,
    "describe_numeric": q_describe_numeric,
    "cleaning_summary": q_cleaning_summary,
    "mart_category_sales": q_mart_category_sales,
    "mart_subcategory_rank": q_mart_subcategory_rank,
    "mart_yearly_revenue": q_mart_yearly_revenue,
    "mart_region_performance": q_mart_region_performance,
    "schema_report": q_schema_report,
    "kpi_yearly_selected": q_kpi_yearly_selected,
    "kpi_yearly_none": q_kpi_yearly_none,
    "kpi_category_selected": q_kpi_category_selected,
    "top_subcategories_selected": q_top_subcategories_selected,
    "profit_efficiency": q_profit_efficiency,
    "revenue_per_order": q_revenue_per_order,
    "kpi_yearly": q_kpi_yearly,
    "kpi_category": q_kpi_category,
    "top_subcategories": q_top_subcategories,
    "yearly_trend_selected": q_yearly_trend_selected,
    "category_totals": q_category_totals,
    "region_table": q_region_table,
}
