"""Serving queries: what the dashboards read, as DataFrame operators over marts and
stream result tables. Filters are typed arguments (never spliced SQL text), so they
push down to the mart scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skiff.functions.bands import aqi_severity
from skiff.functions.numeric import exact_mean, percent_of, ratio
from skiff.operators.windows import latest_per_key


# ---------------------------------------------------------------- retail marts
def mart_filter(
    df: DataFrame,
    category: str | None = None,
    years: Sequence[int] | None = None,
    category_col: str = "Category",
    year_col: str = "Year",
) -> DataFrame:
    """Optional category equality ("all" = None) and year IN-list filter.

    An empty year list is refused, as the dashboard refuses it."""
    if years is not None:
        years = list(years)
        if not years:
            raise ValueError("select at least one year")
        df = df.filter(F.col(year_col).isin(years))
    if category is not None:
        df = df.filter(F.col(category_col) == F.lit(category))
    return df


def profit_efficiency(category_sales: DataFrame) -> DataFrame:
    """Profit as % of sales per category (ratio of the mart's sums), best first."""
    return category_sales.select(
        "Category",
        "TOTAL_SALES",
        "TOTAL_PROFIT",
        percent_of("TOTAL_PROFIT", "TOTAL_SALES", 2).alias("PROFIT_EFFICIENCY_PCT"),
    ).orderBy(F.desc("PROFIT_EFFICIENCY_PCT"), "Category")


def revenue_per_order(yearly_revenue: DataFrame) -> DataFrame:
    """Revenue per order line by year, highest first."""
    return yearly_revenue.select(
        "Year",
        "TOTAL_REVENUE",
        "TOTAL_ORDERS",
        ratio("TOTAL_REVENUE", "TOTAL_ORDERS", 2).alias("AVG_REVENUE_PER_ORDER"),
    ).orderBy(F.desc("AVG_REVENUE_PER_ORDER"), "Year")


def kpi_yearly(yearly_revenue: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Total revenue, total orders and the UNWEIGHTED mean of yearly margins over
    the selected years; NULL KPIs (nothing selected) become 0."""
    sel = mart_filter(yearly_revenue, years=years)
    return sel.agg(
        F.coalesce(F.sum("TOTAL_REVENUE"), F.lit(0)).alias("TOTAL_REV"),
        F.coalesce(F.sum("TOTAL_ORDERS"), F.lit(0)).alias("TOTAL_ORD"),
        F.coalesce(exact_mean("AVG_MARGIN", 2), F.lit(0)).alias("AVG_MARGIN"),
    )


def kpi_category(category_sales: DataFrame, category: str | None = None) -> DataFrame:
    sel = mart_filter(category_sales, category=category)
    return sel.agg(
        F.coalesce(F.sum("TOTAL_SALES"), F.lit(0)).alias("CAT_SALES"),
        F.coalesce(F.sum("TOTAL_PROFIT"), F.lit(0)).alias("CAT_PROFIT"),
    )


def top_subcategories(subcategory_rank: DataFrame, category: str | None = None, n: int = 10) -> DataFrame:
    """Top-n sub-categories by sales (ties broken by category, sub-category)."""
    sel = mart_filter(subcategory_rank, category=category)
    return (
        sel.select(
            F.col("Sub_Category").alias("SUB_CATEGORY"),
            F.col("Category").alias("CATEGORY"),
            "TOTAL_SALES",
            "TOTAL_PROFIT",
        )
        .orderBy(F.desc("TOTAL_SALES"), "CATEGORY", "SUB_CATEGORY")
        .limit(n)
    )


def yearly_trend(yearly_revenue: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    return (
        mart_filter(yearly_revenue, years=years)
        .select("Year", "TOTAL_REVENUE", "TOTAL_PROFIT")
        .orderBy("Year")
    )


def category_totals(category_sales: DataFrame) -> DataFrame:
    return category_sales.select("Category", "TOTAL_SALES", "TOTAL_PROFIT").orderBy(
        F.desc("TOTAL_SALES"), "Category"
    )


def region_table(region_performance: DataFrame) -> DataFrame:
    """Region revenue vs margin table (TOTAL_ORDERS as a 64-bit integer)."""
    return region_performance.select(
        "Region",
        "TOTAL_REVENUE",
        "AVG_ORDER_VALUE",
        "AVG_MARGIN",
        F.col("TOTAL_ORDERS").cast("bigint").alias("TOTAL_ORDERS"),
    ).orderBy(F.desc("TOTAL_REVENUE"), "Region")


# ---------------------------------------------------------- stream result tables
def live_kpis(window_results: DataFrame) -> DataFrame:
    """Total records, mean of window averages (exact, 2 places), peak AQI, #windows. A window
    whose average is no number is left out of the mean, as the reference's mean leaves it out;
    an infinite average makes the mean infinite."""
    avg = F.nullif(F.col("avg_aqi"), F.lit(float("nan")))
    infinite = F.sum(F.when(F.abs(avg) == F.lit(float("inf")), avg))
    return window_results.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.coalesce(infinite, exact_mean(avg, 2).cast("double")).alias("global_avg_aqi"),
        F.max("max_aqi").alias("peak_aqi"),
        F.count(F.lit(1)).alias("active_windows"),
    )


def band_distribution(band_counts: DataFrame) -> DataFrame:
    """Band counts with each band's share of the total (percent, 2 places).

    The input has one row per band (a fixed set of six), so the whole-table window
    for the total is bounded."""
    total = F.sum("count").over(Window.partitionBy()).cast("decimal(20,0)")
    share = percent_of(F.col("count").cast("decimal(20,0)"), total, 2).cast("double")
    return band_counts.select("band", "count", share.alias("share_pct")).orderBy(F.desc("count"), "band")


def dominant_band(band_counts: DataFrame) -> DataFrame:
    """Band with the largest count; ties go to the more severe band."""
    return band_counts.agg(
        F.max_by(F.col("band"), F.struct(F.col("count"), aqi_severity("band"))).alias("band"),
        F.max("count").alias("count"),
    )


def latest_per_state(window_results: DataFrame) -> DataFrame:
    """Average AQI and band of each state's newest window."""
    return latest_per_key(
        window_results, ["state"], ["window_start"], ["window_start", "avg_aqi", "band"]
    )


def newest_windows(window_results: DataFrame, n: int = 20) -> DataFrame:
    """Newest n windows (ties by state)."""
    return window_results.orderBy(F.desc("window_start"), F.desc("state")).limit(n)


def timeline(window_results: DataFrame, n: int = 50) -> DataFrame:
    """Newest n windows, returned oldest first (ties by state)."""
    newest = window_results.select("window_start", "state", "avg_aqi").orderBy(
        F.desc("window_start"), F.desc("state")
    ).limit(n)
    return newest.orderBy("window_start", "state")


def compare_windows(tumbling: DataFrame, sliding: DataFrame, n: int = 15) -> DataFrame:
    """Latest average per state on both sides, states present on both, sorted, first n."""
    t = latest_per_state(tumbling).select("state", F.col("avg_aqi").alias("tumbling_avg_aqi"))
    s = latest_per_state(sliding).select("state", F.col("avg_aqi").alias("sliding_avg_aqi"))
    return t.join(s, "state", "inner").orderBy("state").limit(n)


def common_states(tumbling: DataFrame, sliding: DataFrame) -> DataFrame:
    return tumbling.select("state").intersect(sliding.select("state"))
