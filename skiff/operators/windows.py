"""Window analytics: rank, running total, period-over-period growth, latest per key.

Window functions run after aggregation, so each window partition holds at most
#years (or #sub-categories) rows however large the input is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skiff.functions.numeric import percent_of


def rank_subcategories(df: DataFrame) -> DataFrame:
    """Dense rank of sub-categories within their category by rounded total sales:
    Category, Sub_Category, Total_Sales, Total_Profit, Sales_Rank (ties in rank
    listed by sub-category)."""
    totals = df.groupBy("Category", "Sub_Category").agg(
        F.round(F.sum("Sales"), 2).alias("Total_Sales"),
        F.round(F.sum("Profit"), 2).alias("Total_Profit"),
    )
    w = Window.partitionBy("Category").orderBy(F.desc("Total_Sales"))
    return totals.withColumn("Sales_Rank", F.dense_rank().over(w)).orderBy(
        "Category", "Sales_Rank", "Sub_Category"
    )


def yearly_category_sales(df: DataFrame) -> DataFrame:
    return df.groupBy("Category", "Year").agg(F.round(F.sum("Sales"), 2).alias("Yearly_Sales"))


def cumulative_revenue(df: DataFrame) -> DataFrame:
    """Running total of (rounded) yearly sales per category, ROWS unbounded → current."""
    w = (
        Window.partitionBy("Category")
        .orderBy("Year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        yearly_category_sales(df)
        .withColumn("Cumulative_Revenue", F.round(F.sum("Yearly_Sales").over(w), 2))
        .orderBy("Category", "Year")
    )


def yoy_growth(df: DataFrame) -> DataFrame:
    """Year-over-year growth % against the previous *row* of the category (a missing
    year is skipped over); NULL for the first year and when the previous sales are 0."""
    w = Window.partitionBy("Category").orderBy("Year")
    prev = F.lag("Yearly_Sales", 1).over(w)
    return (
        yearly_category_sales(df)
        .withColumn("Prev_Year_Sales", prev)
        .withColumn(
            "YoY_Growth_Pct",
            percent_of(F.col("Yearly_Sales") - F.col("Prev_Year_Sales"), "Prev_Year_Sales", 2),
        )
        .orderBy("Category", "Year")
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    values: Sequence[str],
) -> DataFrame:
    """For each key, the row with the greatest ``order`` tuple.

    Implemented as ``max_by(struct(values), struct(order))``: a partial aggregate, so
    a key holding a third of all rows is reduced map-side instead of being sorted in
    one task (``row_number() = 1`` would sort the whole partition).
    """
    order_struct = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(v) for v in values]), order_struct).alias("_latest")
    )
    return picked.select(*keys, *[F.col(f"_latest.{v}").alias(v) for v in values])
