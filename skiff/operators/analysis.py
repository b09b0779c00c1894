"""The analysis questions of the batch flow under the reference's analysis column
names: revenue and profit by category, average order value by region, yearly
revenue trend. They are the mart aggregates (``marts``) renamed; the SQL forms of
the trend and of sub-category profitability are in ``marts`` as SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from skiff.operators import marts

# ---------------------------------------------------------------------------
# Output names of the analysis questions (mart name → analysis name).
# ---------------------------------------------------------------------------
CATEGORY_NAMES = {
    "TOTAL_SALES": "Total_Sales",
    "TOTAL_PROFIT": "Total_Profit",
    "ORDER_COUNT": "Order_Count",
    "AVG_PROFIT_MARGIN": "Avg_Profit_Margin_Pct",
}
REGION_NAMES = {
    "AVG_ORDER_VALUE": "Avg_Order_Value",
    "TOTAL_REVENUE": "Total_Revenue",
    "AVG_MARGIN": "Avg_Margin_Pct",
    "TOTAL_ORDERS": "Total_Orders",
}
YEARLY_NAMES = {
    "TOTAL_REVENUE": "Total_Revenue",
    "TOTAL_PROFIT": "Total_Profit",
    "TOTAL_ORDERS": "Total_Orders",
    "AVG_MARGIN": "Avg_Margin_Pct",
}


def category_revenue(df: DataFrame) -> DataFrame:
    """Revenue and profit by category, highest sales first."""
    return marts.category_sales(df).withColumnsRenamed(CATEGORY_NAMES)


def region_order_value(df: DataFrame) -> DataFrame:
    """Average order value by region, highest first."""
    return marts.region_performance(df, order_by="AVG_ORDER_VALUE").withColumnsRenamed(REGION_NAMES)


def yearly_revenue_trend(df: DataFrame) -> DataFrame:
    """Yearly revenue trend, DataFrame form (the SQL form is ``marts.yearly_revenue_sql``)."""
    return marts.yearly_revenue(df).withColumnsRenamed(YEARLY_NAMES)
