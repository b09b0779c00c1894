"""Aggregate marts over cleaned order lines.

Each mart is one ``HashAggregate(partial) → Exchange → HashAggregate(final)``: only
#groups rows per task cross the network, so a hot key (a category holding a third
of all rows) costs nothing extra. ``build_marts`` produces all four marts from a
single scan with GROUPING SETS instead of re-reading the input four times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skiff.session import new_run_dir
from skiff.functions.numeric import MEAN_ACC, exact_mean, rounded_quotient, sql_rounded_quotient


def _totals(sales: str = "TOTAL_SALES", profit: str = "TOTAL_PROFIT", n: str = "ORDER_COUNT"):
    return [
        F.round(F.sum("Sales"), 2).alias(sales),
        F.round(F.sum("Profit"), 2).alias(profit),
        F.count(F.lit(1)).alias(n),
    ]


def category_sales(df: DataFrame) -> DataFrame:
    """Revenue and profit by category (CATEGORY_SALES)."""
    return (
        df.groupBy("Category")
        .agg(*_totals(), exact_mean("Profit_Margin", 2).alias("AVG_PROFIT_MARGIN"))
        .orderBy(F.desc("TOTAL_SALES"), "Category")
    )


def region_performance(df: DataFrame, order_by: str = "TOTAL_REVENUE") -> DataFrame:
    """Average order value by region (REGION_PERFORMANCE). ``order_by`` is
    TOTAL_REVENUE (mart) or AVG_ORDER_VALUE (analysis question)."""
    return (
        df.groupBy("Region")
        .agg(
            exact_mean("Sales", 2).alias("AVG_ORDER_VALUE"),
            F.round(F.sum("Sales"), 2).alias("TOTAL_REVENUE"),
            exact_mean("Profit_Margin", 2).alias("AVG_MARGIN"),
            F.count(F.lit(1)).alias("TOTAL_ORDERS"),
        )
        .orderBy(F.desc(order_by), "Region")
    )


def yearly_revenue(df: DataFrame) -> DataFrame:
    """Yearly revenue trend (YEARLY_REVENUE), DataFrame form."""
    return (
        df.groupBy("Year")
        .agg(
            *_totals("TOTAL_REVENUE", "TOTAL_PROFIT", "TOTAL_ORDERS"),
            exact_mean("Profit_Margin", 2).alias("AVG_MARGIN"),
        )
        .orderBy("Year")
    )


# Exact-average expression for SQL text: sum in DECIMAL, one exact rounded division
# by the count (see ``rounded_quotient``).
_SQL_MEAN = sql_rounded_quotient("SUM(CAST({c} AS " + MEAN_ACC + "))", "COUNT({c})", 2)


def yearly_revenue_sql(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Yearly revenue trend through Spark SQL (same plan as the DataFrame form)."""
    return spark.sql(
        f"""
        SELECT YEAR(Order_Date)      AS Year,
               ROUND(SUM(Sales), 2)  AS Total_Revenue,
               ROUND(SUM(Profit), 2) AS Total_Profit,
               COUNT(*)              AS Total_Orders,
               {_SQL_MEAN.format(c="Profit_Margin")} AS Avg_Margin_Pct
        FROM {{orders}}
        GROUP BY YEAR(Order_Date)
        ORDER BY Year ASC
        """,
        orders=df,
    )


def subcategory_profit_sql(spark: SparkSession, df: DataFrame, losses_only: bool = False) -> DataFrame:
    """Sub-category profitability through Spark SQL, least profitable first.

    ``losses_only=True`` adds the ``HAVING SUM(Profit) < 0`` that restricts the
    answer to loss-making sub-categories."""
    having = "HAVING SUM(Profit) < 0" if losses_only else ""
    return spark.sql(
        f"""
        SELECT Sub_Category, Category,
               ROUND(SUM(Sales), 2)  AS Total_Sales,
               ROUND(SUM(Profit), 2) AS Total_Profit,
               {_SQL_MEAN.format(c="Profit_Margin")} AS Avg_Margin_Pct,
               COUNT(*)              AS Order_Count
        FROM {{orders}}
        GROUP BY Sub_Category, Category
        {having}
        ORDER BY Total_Profit ASC, Category, Sub_Category
        """,
        orders=df,
    )


def subcategory_totals(df: DataFrame) -> DataFrame:
    """Per (Category, Sub_Category) totals feeding the rank."""
    return df.groupBy("Category", "Sub_Category").agg(
        F.round(F.sum("Sales"), 2).alias("TOTAL_SALES"),
        F.round(F.sum("Profit"), 2).alias("TOTAL_PROFIT"),
        exact_mean("Profit_Margin", 2).alias("AVG_MARGIN"),
        F.count(F.lit(1)).alias("ORDER_COUNT"),
    )


def _with_sales_rank(totals: DataFrame) -> DataFrame:
    w = Window.partitionBy("Category").orderBy(F.desc("TOTAL_SALES"))
    return totals.withColumn("SALES_RANK", F.dense_rank().over(w)).orderBy(
        "Category", "SALES_RANK", "Sub_Category"
    )


def subcategory_rank(df: DataFrame) -> DataFrame:
    """SUBCATEGORY_RANK: dense rank of sub-categories by sales within category."""
    return _with_sales_rank(subcategory_totals(df))


MART_NAMES = ("CATEGORY_SALES", "YEARLY_REVENUE", "REGION_PERFORMANCE", "SUBCATEGORY_RANK")
_SET_KEYS = {
    "CATEGORY_SALES": ("Category",),
    "YEARLY_REVENUE": ("Year",),
    "REGION_PERFORMANCE": ("Region",),
    "SUBCATEGORY_RANK": ("Category", "Sub_Category"),
}
_ALL_KEYS = ("Category", "Year", "Region", "Sub_Category")


def _grouping_id(keys: tuple[str, ...]) -> int:
    # bit i (most significant first) is 1 when _ALL_KEYS[i] is aggregated away
    gid = 0
    for k in _ALL_KEYS:
        gid = (gid << 1) | (0 if k in keys else 1)
    return gid


def mart_groups(df: DataFrame) -> DataFrame:
    """The GROUPING SETS aggregate behind all four marts: ONE scan of the cleaned
    lines, partial aggregation before the exchange, #groups rows out."""
    return df.groupingSets([list(k) for k in _SET_KEYS.values()], *_ALL_KEYS).agg(
        F.grouping_id().alias("_gid"),
        F.sum("Sales").alias("_sales"),
        F.sum("Profit").alias("_profit"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("Sales").cast(MEAN_ACC)).alias("_sales_acc"),
        F.count("Sales").alias("_sales_n"),
        F.sum(F.col("Profit_Margin").cast(MEAN_ACC)).alias("_margin_acc"),
        F.count("Profit_Margin").alias("_margin_n"),
    )


def build_marts(df: DataFrame) -> dict[str, DataFrame]:
    """All four marts from ONE scan of the cleaned lines (GROUPING SETS).

    The grouped result (#groups rows) is written to the shared folder, so that publishing
    the four marts does not run the scan again and nothing stays cached.
    """
    folder = new_run_dir(df.sparkSession, "mart-groups")
    mart_groups(df).write.parquet(folder)
    return marts_from_groups(df.sparkSession.read.parquet(folder))


def marts_from_groups(grouped: DataFrame) -> dict[str, DataFrame]:
    """Split a ``mart_groups`` result (live or read back from storage) into the
    four marts."""

    def part(name: str) -> DataFrame:
        return grouped.filter(F.col("_gid") == _grouping_id(_SET_KEYS[name]))

    def mean(acc: str, n: str):
        return rounded_quotient(F.col(acc), F.col(n), 2)

    sales = F.round(F.col("_sales"), 2)
    profit = F.round(F.col("_profit"), 2)
    margin = mean("_margin_acc", "_margin_n")
    return {
        "CATEGORY_SALES": part("CATEGORY_SALES")
        .select(
            "Category",
            sales.alias("TOTAL_SALES"),
            profit.alias("TOTAL_PROFIT"),
            F.col("_n").alias("ORDER_COUNT"),
            margin.alias("AVG_PROFIT_MARGIN"),
        )
        .orderBy(F.desc("TOTAL_SALES"), "Category"),
        "YEARLY_REVENUE": part("YEARLY_REVENUE")
        .select(
            "Year",
            sales.alias("TOTAL_REVENUE"),
            profit.alias("TOTAL_PROFIT"),
            F.col("_n").alias("TOTAL_ORDERS"),
            margin.alias("AVG_MARGIN"),
        )
        .orderBy("Year"),
        "REGION_PERFORMANCE": part("REGION_PERFORMANCE")
        .select(
            "Region",
            mean("_sales_acc", "_sales_n").alias("AVG_ORDER_VALUE"),
            sales.alias("TOTAL_REVENUE"),
            margin.alias("AVG_MARGIN"),
            F.col("_n").alias("TOTAL_ORDERS"),
        )
        .orderBy(F.desc("TOTAL_REVENUE"), "Region"),
        "SUBCATEGORY_RANK": _with_sales_rank(
            part("SUBCATEGORY_RANK").select(
                "Category",
                "Sub_Category",
                sales.alias("TOTAL_SALES"),
                profit.alias("TOTAL_PROFIT"),
                margin.alias("AVG_MARGIN"),
                F.col("_n").alias("ORDER_COUNT"),
            )
        ),
    }
