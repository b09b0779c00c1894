"""Tolerant load and cleaning of order lines (schema-on-read strings → typed rows).

Every step is a column expression; Catalyst collapses the rename, casts, parse,
filters and derivations into one projection + filter inside a single codegen stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from skiff.functions.bands import sales_band
from skiff.functions.numeric import MONEY, row_percent_of

# Target types of the tolerant cast. Money is DECIMAL so sums are exact; the
# reference used double. Unparseable text becomes NULL.
ORDER_LINE_TYPES: Mapping[str, str] = {
    "Sales": MONEY,
    "Profit": MONEY,
    "Quantity": "int",
    "Discount": "decimal(10,4)",
    "Shipping_Cost": MONEY,
}
ORDER_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
DATE_COLUMNS = ("Order_Date", "Ship_Date")
REQUIRED_COLUMNS = ("Sales", "Profit", "Order_Date", "Category", "Region")


def normalise_names(df: DataFrame) -> DataFrame:
    """Replace dots in column names with underscores in one projection."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def tolerant_cast(df: DataFrame, types: Mapping[str, str] = ORDER_LINE_TYPES) -> DataFrame:
    """``try_cast`` the listed columns (those present); bad values become NULL."""
    return df.select(
        *[
            F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def parse_dates(
    df: DataFrame, columns: Sequence[str] = DATE_COLUMNS, fmt: str = ORDER_DATE_FORMAT
) -> DataFrame:
    """Parse date text with ``fmt``; unparseable text becomes NULL (no ANSI error)."""
    present = [c for c in columns if c in df.columns]
    if fmt == ORDER_DATE_FORMAT:
        return df.withColumns({c: F.coalesce(_midnight(F.col(c)), F.try_to_date(F.col(c), fmt)) for c in present})
    return df.withColumns({c: F.try_to_date(F.col(c), fmt) for c in present})


def _midnight(text: Column) -> Column:
    """The date of ORDER_DATE_FORMAT text at midnight, NULL for any other text: a cast of its ten
    characters takes a fraction of the time of the formatter, which is left the rest."""
    at = lambda i: F.substring(text, i, 1)
    # a cast alone would take one digit of a day, spaces and signs too
    plain = (at(5) == "-") & (at(8) == "-") & at(10).between("0", "9")
    return F.when(
        (F.length(text) == 23) & F.endswith(text, F.lit(" 00:00:00.000")) & plain,
        F.substring(text, 1, 10).try_cast("date"),
    )


def type_order_lines(raw: DataFrame) -> DataFrame:
    """Raw CSV strings → typed order lines (names, casts, dates)."""
    return parse_dates(tolerant_cast(normalise_names(raw)))


def _present(c: str, df: DataFrame) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def keep_predicate(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> Column:
    """Row survives cleaning: required fields present (not NULL/NaN) and Sales > 0.

    The NULL/NaN test is applied before ``Sales > 0`` because NaN > 0 is TRUE in Spark.
    """
    cond = F.lit(True)
    for c in required:
        cond = cond & _present(c, df)
    return cond & (F.col("Sales") > 0)


def clean_order_lines(typed: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows missing a required field, then rows with non-positive Sales."""
    return typed.filter(keep_predicate(typed, required))


def derive_order_measures(df: DataFrame) -> DataFrame:
    """Add Profit_Margin (% of Sales, 2 places), Sales_Band and Year."""
    return df.withColumns(
        {
            "Profit_Margin": row_percent_of("Profit", "Sales", 2),
            "Sales_Band": sales_band("Sales"),
            "Year": F.year("Order_Date"),
        }
    )


def load_clean(raw: DataFrame) -> DataFrame:
    """The full tolerant-load chain used by every retail query."""
    return derive_order_measures(clean_order_lines(type_order_lines(raw)))
