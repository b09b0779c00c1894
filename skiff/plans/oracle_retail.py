"""DuckDB twins of the retail contract queries (tables pre-registered as views).

DuckDB divides DECIMALs in DOUBLE, so every rounded ratio or mean is written in
integer cents with an explicit half-up (away from zero) rule — the exact result
Spark's DECIMAL ``round`` gives.
"""

from __future__ import annotations

from skiff.plans.retail import EMPTY_YEAR, SELECTED_CATEGORY, SELECTED_YEARS


def half_up(num: str, den: str) -> str:
    """round(num / den) half away from zero, integers, den > 0."""
    return (
        f"((CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END)"
        f" * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"
    )


def hundredths(h: str) -> str:
    """Integer hundredths → DOUBLE value."""
    return f"(CAST({h} AS DOUBLE) / 100)"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


def millionths(x: str) -> str:
    return f"CAST(({x}) * 1000000 AS BIGINT)"


_NET = "CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))"
_DT = "'%Y-%m-%d %H:%M:%S.%g'"

CTES = f"""
order_lines AS (
  SELECT l.l_orderkey AS Order_ID, l.l_linenumber AS Line_No, l.l_partkey AS Product_ID,
         o.o_custkey AS Customer_ID, c.c_name AS Customer_Name, o.o_orderpriority AS Order_Priority,
         p.p_name AS Product_Name, CAST(o.o_orderdate AS DATE) AS Order_Date,
         CAST(l.l_shipdate AS DATE) AS Ship_Date, p.p_type AS Category, p.p_brand AS Sub_Category,
         r.r_name AS Region, c.c_mktsegment AS Segment, CAST(l.l_quantity AS INTEGER) AS Quantity,
         CAST(l.l_discount AS DECIMAL(4,2)) AS Discount,
         CAST({_NET} * 0.01 AS DECIMAL(18,6)) AS Sales,
         CAST(({_NET} - CAST(l.l_quantity AS DECIMAL(6,0)) * CAST(p.p_retailprice AS DECIMAL(10,2)) * 2.1)
              * 0.01 AS DECIMAL(18,6)) AS Profit,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)) * 0.01 AS DECIMAL(18,6)) AS Shipping_Cost
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
raw AS (
  SELECT CAST(Order_ID AS VARCHAR) AS "Order.ID", CAST(Line_No AS VARCHAR) AS "Line.No",
         CASE WHEN Order_ID % 101 = 0 THEN 'bad'
              ELSE strftime(CAST(Order_Date AS TIMESTAMP), {_DT}) END AS "Order.Date",
         strftime(CAST(Ship_Date AS TIMESTAMP), {_DT}) AS "Ship.Date",
         CAST(Customer_ID AS VARCHAR) AS "Customer.ID", Customer_Name AS "Customer.Name",
         Order_Priority AS "Order.Priority", CAST(Product_ID AS VARCHAR) AS "Product.ID",
         Product_Name AS "Product.Name", Category, Sub_Category AS "Sub.Category", Segment,
         CASE WHEN Order_ID % 103 = 0 THEN NULL ELSE Region END AS Region,
         CAST(Quantity AS VARCHAR) AS Quantity, CAST(Discount AS VARCHAR) AS Discount,
         CASE WHEN Order_ID % 97 = 0 THEN 'n/a' WHEN Order_ID % 89 = 0 THEN ''
              WHEN Order_ID % 83 = 0 THEN CAST(-Sales AS VARCHAR) ELSE CAST(Sales AS VARCHAR) END AS Sales,
         CAST(Profit AS VARCHAR) AS Profit, CAST(Shipping_Cost AS VARCHAR) AS "Shipping.Cost"
  FROM order_lines
),
typed AS (
  SELECT "Order.ID" AS Order_ID, "Line.No" AS Line_No,
         CAST(TRY_STRPTIME("Order.Date", {_DT}) AS DATE) AS Order_Date,
         CAST(TRY_STRPTIME("Ship.Date", {_DT}) AS DATE) AS Ship_Date,
         "Customer.ID" AS Customer_ID, "Customer.Name" AS Customer_Name,
         "Order.Priority" AS Order_Priority, "Product.ID" AS Product_ID, "Product.Name" AS Product_Name,
         Category, "Sub.Category" AS Sub_Category, Segment, Region,
         TRY_CAST(Quantity AS INTEGER) AS Quantity, TRY_CAST(Discount AS DECIMAL(10,4)) AS Discount,
         TRY_CAST(Sales AS DECIMAL(18,6)) AS Sales, TRY_CAST(Profit AS DECIMAL(18,6)) AS Profit,
         TRY_CAST("Shipping.Cost" AS DECIMAL(18,6)) AS Shipping_Cost
  FROM raw
),
kept AS (
  SELECT * FROM typed
  WHERE Sales IS NOT NULL AND Profit IS NOT NULL AND Order_Date IS NOT NULL
    AND Category IS NOT NULL AND Region IS NOT NULL AND Sales > 0
),
lines AS (
  SELECT *, {half_up(f"{millionths('Profit')} * 10000", millionths('Sales'))} AS margin_h,
         CASE WHEN Sales >= 1000 THEN 'High' WHEN Sales >= 300 THEN 'Medium' ELSE 'Low' END AS Sales_Band,
         CAST(year(Order_Date) AS INTEGER) AS Year
  FROM kept
)"""


def with_ctes(body: str, extra: str = "") -> str:
    return f"WITH {CTES}{extra}\n{body}"


def _mean_h(h: str) -> str:
    """Exact 2-place mean of integer hundredths, as hundredths."""
    return half_up(f"SUM({h})", f"COUNT({h})")


def _money(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


# Per-group totals in exact form (hundredths for means), shared by marts.
def _group_totals(keys: str) -> str:
    return f"""
  SELECT {keys}, ROUND(SUM(Sales), 2) AS sales, ROUND(SUM(Profit), 2) AS profit, SUM(Profit) < 0 AS loses, COUNT(*) AS n,
         {_mean_h('margin_h')} AS margin_h, {half_up(f"SUM({millionths('Sales')})", 'COUNT(Sales) * 10000')} AS aov_h
  FROM lines GROUP BY {keys}"""


MARTS = f""",
cat AS ({_group_totals('Category')}),
yr AS ({_group_totals('Year')}),
reg AS ({_group_totals('Region')}),
sub AS ({_group_totals('Category, Sub_Category')}),
sub_rank AS (
  SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY Category ORDER BY sales DESC) AS INTEGER) AS rnk FROM sub
)"""

_TYPED_OUT = """Order_ID, Line_No, CAST(Order_Date AS VARCHAR) AS Order_Date, CAST(Ship_Date AS VARCHAR) AS Ship_Date,
       Customer_ID, Customer_Name, Order_Priority, Product_ID, Product_Name, Category, Sub_Category,
       Segment, Region, Quantity, CAST(Discount AS DOUBLE) AS Discount, CAST(Sales AS DOUBLE) AS Sales,
       CAST(Profit AS DOUBLE) AS Profit, CAST(Shipping_Cost AS DOUBLE) AS Shipping_Cost"""

_YEARLY_CAT = """,
ycat AS (SELECT Category, Year, ROUND(SUM(Sales), 2) AS ys FROM lines GROUP BY Category, Year)"""


# Columns of the quality report and their types, in the input's order.
REPORTED = [(c, "string") for c in (
    "Order_ID", "Line_No", "Order_Date", "Ship_Date", "Customer_ID", "Customer_Name", "Order_Priority", "Product_ID",
    "Product_Name", "Category", "Sub_Category", "Segment", "Region",
)] + [("Quantity", "int"), ("Discount", "decimal(10,4)"), ("Sales", "decimal(18,6)"), ("Profit", "decimal(18,6)"), ("Shipping_Cost", "decimal(18,6)")]
AS_LOADED = """,
as_loaded AS (
  SELECT "Order.ID" AS Order_ID, "Line.No" AS Line_No, "Order.Date" AS Order_Date, "Ship.Date" AS Ship_Date,
         "Customer.ID" AS Customer_ID, "Customer.Name" AS Customer_Name, "Order.Priority" AS Order_Priority,
         "Product.ID" AS Product_ID, "Product.Name" AS Product_Name, Category, "Sub.Category" AS Sub_Category, Segment, Region,
         TRY_CAST(Quantity AS INTEGER) AS Quantity, TRY_CAST(Discount AS DECIMAL(10,4)) AS Discount,
         TRY_CAST(Sales AS DECIMAL(18,6)) AS Sales, TRY_CAST(Profit AS DECIMAL(18,6)) AS Profit,
         TRY_CAST("Shipping.Cost" AS DECIMAL(18,6)) AS Shipping_Cost
  FROM raw)"""

ORACLES: dict[str, str] = {
    "clean_orders": with_ctes(
        f"SELECT {_TYPED_OUT}, {hundredths('margin_h')} AS Profit_Margin, Sales_Band, Year FROM lines"
    ),
    "tolerant_cast": with_ctes(
        """SELECT Order_ID, Line_No, CAST(Order_Date AS VARCHAR) AS Order_Date, CAST(Sales AS DOUBLE) AS Sales,
       CAST(Profit AS DOUBLE) AS Profit, Quantity, CAST(Discount AS DOUBLE) AS Discount,
       CAST(Shipping_Cost AS DOUBLE) AS Shipping_Cost FROM typed"""
    ),
    "profit_margin": with_ctes(
        f"""SELECT Order_ID, Line_No, CAST(Sales AS DOUBLE) AS Sales, CAST(Profit AS DOUBLE) AS Profit,
       {hundredths('margin_h')} AS Profit_Margin FROM lines"""
    ),
    "sales_band_counts": with_ctes(
        "SELECT Sales_Band, COUNT(*) AS LINE_COUNT FROM lines GROUP BY Sales_Band ORDER BY LINE_COUNT DESC"
    ),
    "order_line_count": with_ctes("SELECT COUNT(*) AS row_count FROM typed"),
    "category_sales": with_ctes(
        f"""SELECT Category, {_money('sales')} AS Total_Sales, {_money('profit')} AS Total_Profit,
       n AS Order_Count, {hundredths('margin_h')} AS Avg_Profit_Margin_Pct
FROM cat ORDER BY Total_Sales DESC""",
        MARTS,
    ),
    "region_performance": with_ctes(
        f"""SELECT Region, {hundredths('aov_h')} AS Avg_Order_Value, {_money('sales')} AS Total_Revenue,
       {hundredths('margin_h')} AS Avg_Margin_Pct, n AS Total_Orders
FROM reg ORDER BY Avg_Order_Value DESC""",
        MARTS,
    ),
    "yearly_revenue": with_ctes(
        f"""SELECT Year, {_money('sales')} AS Total_Revenue, {_money('profit')} AS Total_Profit,
       n AS Total_Orders, {hundredths('margin_h')} AS Avg_Margin_Pct FROM yr ORDER BY Year""",
        MARTS,
    ),
    "subcategory_profit_sql": with_ctes(
        f"""SELECT Sub_Category, Category, {_money('sales')} AS Total_Sales, {_money('profit')} AS Total_Profit,
       {hundredths('margin_h')} AS Avg_Margin_Pct, n AS Order_Count FROM sub ORDER BY Total_Profit""",
        MARTS,
    ),
    "subcategory_losses": with_ctes(
        f"""SELECT Sub_Category, Category, {_money('sales')} AS Total_Sales, {_money('profit')} AS Total_Profit,
       {hundredths('margin_h')} AS Avg_Margin_Pct, n AS Order_Count FROM sub WHERE loses
ORDER BY Total_Profit""",
        MARTS,
    ),
    "subcategory_rank": with_ctes(
        f"""SELECT Category, Sub_Category, {_money('sales')} AS Total_Sales, {_money('profit')} AS Total_Profit,
       rnk AS Sales_Rank
FROM sub_rank ORDER BY Category, Sales_Rank, Sub_Category""",
        MARTS,
    ),
    "cumulative_revenue": with_ctes(
        """SELECT Category, Year, CAST(ys AS DOUBLE) AS Yearly_Sales,
       CAST(SUM(ys) OVER (PARTITION BY Category ORDER BY Year
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS Cumulative_Revenue
FROM ycat ORDER BY Category, Year""",
        _YEARLY_CAT,
    ),
    "yoy_growth": with_ctes(
        f"""SELECT Category, Year, CAST(ys AS DOUBLE) AS Yearly_Sales, CAST(prev AS DOUBLE) AS Prev_Year_Sales,
       CASE WHEN prev IS NULL OR prev = 0 THEN NULL
            ELSE {hundredths(half_up(f"{cents('ys - prev')} * 10000", cents('prev')))} END AS YoY_Growth_Pct
FROM (SELECT *, LAG(ys, 1) OVER (PARTITION BY Category ORDER BY Year) AS prev FROM ycat) t
ORDER BY Category, Year""",
        _YEARLY_CAT,
    ),
    # with the dates parsed: text that is no date counts as NULL
    "null_counts": with_ctes(
        "SELECT " + ", ".join(f"CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS {c}" for c, _ in REPORTED) + " FROM typed"
    ),
    # before the dates are parsed: they are still text
    "schema_report": with_ctes(
        "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, COUNT({c}) AS non_null FROM as_loaded" for c, t in REPORTED), AS_LOADED
    ),
    "value_counts": with_ctes(
        """SELECT column_name, value, COUNT(*) AS n FROM (
  SELECT 'Category' AS column_name, Category AS value FROM typed
  UNION ALL SELECT 'Segment', Segment FROM typed
  UNION ALL SELECT 'Region', Region FROM typed) t
GROUP BY column_name, value ORDER BY column_name, n DESC, value"""
    ),
    "cleaning_summary": with_ctes(
        """SELECT rows_before, rows_after, rows_before - rows_after AS removed
FROM (SELECT COUNT(*) AS rows_before,
             CAST(COUNT_IF(Sales IS NOT NULL AND Profit IS NOT NULL AND Order_Date IS NOT NULL
                           AND Category IS NOT NULL AND Region IS NOT NULL AND Sales > 0) AS BIGINT) AS rows_after
      FROM typed) t"""
    ),
    "profit_efficiency": with_ctes(
        f"""SELECT Category, {_money('sales')} AS TOTAL_SALES, {_money('profit')} AS TOTAL_PROFIT,
       {hundredths(half_up(f"{cents('profit')} * 10000", cents('sales')))} AS PROFIT_EFFICIENCY_PCT
FROM cat ORDER BY PROFIT_EFFICIENCY_PCT DESC""",
        MARTS,
    ),
    "revenue_per_order": with_ctes(
        f"""SELECT Year, {_money('sales')} AS TOTAL_REVENUE, n AS TOTAL_ORDERS,
       {hundredths(half_up(cents('sales'), 'n'))} AS AVG_REVENUE_PER_ORDER
FROM yr ORDER BY AVG_REVENUE_PER_ORDER DESC""",
        MARTS,
    ),
    "kpi_yearly": with_ctes(
        f"""SELECT CAST(COALESCE(SUM(sales), 0) AS DOUBLE) AS TOTAL_REV, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS TOTAL_ORD,
       COALESCE({hundredths(_mean_h('margin_h'))}, 0) AS AVG_MARGIN FROM yr""",
        MARTS,
    ),
    "kpi_category": with_ctes(
        """SELECT CAST(COALESCE(SUM(sales), 0) AS DOUBLE) AS CAT_SALES,
       CAST(COALESCE(SUM(profit), 0) AS DOUBLE) AS CAT_PROFIT FROM cat""",
        MARTS,
    ),
    "top_subcategories": with_ctes(
        f"""SELECT Sub_Category AS SUB_CATEGORY, Category AS CATEGORY, {_money('sales')} AS TOTAL_SALES,
       {_money('profit')} AS TOTAL_PROFIT
FROM sub_rank ORDER BY sales DESC, CATEGORY, SUB_CATEGORY LIMIT 10""",
        MARTS,
    ),
    "yearly_trend_selected": with_ctes(
        f"""SELECT Year, {_money('sales')} AS TOTAL_REVENUE, {_money('profit')} AS TOTAL_PROFIT
FROM yr WHERE Year IN (1996, 1998, 2000) ORDER BY Year""",
        MARTS,
    ),
    "category_totals": with_ctes(
        f"""SELECT Category, {_money('sales')} AS TOTAL_SALES, {_money('profit')} AS TOTAL_PROFIT
FROM cat ORDER BY TOTAL_SALES DESC""",
        MARTS,
    ),
    "region_table": with_ctes(
        f"""SELECT Region, {_money('sales')} AS TOTAL_REVENUE, {hundredths('aov_h')} AS AVG_ORDER_VALUE,
       {hundredths('margin_h')} AS AVG_MARGIN, CAST(n AS BIGINT) AS TOTAL_ORDERS
FROM reg ORDER BY TOTAL_REVENUE DESC""",
        MARTS,
    ),
}

ORACLES["csv_clean_orders"] = ORACLES["clean_orders"]
ORACLES["least_profitable_top20"] = with_ctes(
    f"""SELECT Sub_Category, Category, {_money('sales')} AS Total_Sales, {_money('profit')} AS Total_Profit,
       {hundredths('margin_h')} AS Avg_Margin_Pct, n AS Order_Count FROM sub
ORDER BY profit, Category, Sub_Category LIMIT 20""",
    MARTS,
)
ORACLES["subcategory_rank_top30"] = with_ctes(
    f"""SELECT Category, Sub_Category, {_money('sales')} AS Total_Sales, {_money('profit')} AS Total_Profit,
       rnk AS Sales_Rank
FROM sub_rank ORDER BY Category, Sales_Rank, Sub_Category LIMIT 30""",
    MARTS,
)
ORACLES["yearly_revenue_sql"] = ORACLES["yearly_revenue"]
ORACLES["mart_category_sales"] = with_ctes(
    f"""SELECT Category, {_money('sales')} AS TOTAL_SALES, {_money('profit')} AS TOTAL_PROFIT,
       n AS ORDER_COUNT, {hundredths('margin_h')} AS AVG_PROFIT_MARGIN
FROM cat ORDER BY TOTAL_SALES DESC""",
    MARTS,
)
ORACLES["mart_subcategory_rank"] = with_ctes(
    f"""SELECT Category, Sub_Category, {_money('sales')} AS TOTAL_SALES, {_money('profit')} AS TOTAL_PROFIT,
       {hundredths('margin_h')} AS AVG_MARGIN, n AS ORDER_COUNT, rnk AS SALES_RANK
FROM sub_rank ORDER BY Category, SALES_RANK""",
    MARTS,
)


def _describe() -> str:
    # column -> (value expression, its scale): mean*10^4 = sum(value*10^scale) * 10^(4-scale) / n
    spec = {"Sales": 6, "Profit": 6, "Quantity": 0, "Discount": 4}
    parts = []
    for c, s in spec.items():
        scaled = f"CAST({c} * {10 ** s} AS BIGINT)"
        mean_num, mean_den = f"SUM({scaled}) * {10 ** max(4 - s, 0)}", f"COUNT({c}) * {10 ** max(s - 4, 0)}"
        parts.append(
            f"""SELECT '{c}' AS column_name, COUNT({c}) AS n,
       CAST({half_up(mean_num, mean_den)} AS DOUBLE) / 10000 AS mean,
       ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 4) AS stddev,
       CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value FROM typed"""
        )
    return with_ctes("\nUNION ALL\n".join(parts))


ORACLES["describe_numeric"] = _describe()
ORACLES["mart_yearly_revenue"] = with_ctes(
    f"""SELECT Year, {_money('sales')} AS TOTAL_REVENUE, {_money('profit')} AS TOTAL_PROFIT, n AS TOTAL_ORDERS,
       {hundredths('margin_h')} AS AVG_MARGIN FROM yr""",
    MARTS,
)
ORACLES["mart_region_performance"] = with_ctes(
    f"""SELECT Region, {hundredths('aov_h')} AS AVG_ORDER_VALUE, {_money('sales')} AS TOTAL_REVENUE,
       {hundredths('margin_h')} AS AVG_MARGIN, n AS TOTAL_ORDERS FROM reg""",
    MARTS,
)
# the dashboard's selections: years, a category, and years without data
ORACLES["kpi_yearly_selected"] = ORACLES["kpi_yearly"] + f" WHERE Year IN {SELECTED_YEARS}"
ORACLES["kpi_yearly_none"] = ORACLES["kpi_yearly"] + f" WHERE Year = {EMPTY_YEAR}"
ORACLES["kpi_category_selected"] = ORACLES["kpi_category"] + f" WHERE Category = '{SELECTED_CATEGORY}'"
ORACLES["top_subcategories_selected"] = ORACLES["top_subcategories"].replace(
    "FROM sub_rank ORDER", f"FROM sub_rank WHERE Category = '{SELECTED_CATEGORY}' ORDER")
