"""Data-quality reporting: single reports, and the whole report from one scan of the raw text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skiff.functions.numeric import exact_mean
from skiff.operators.clean import ORDER_DATE_FORMAT, keep_predicate, normalise_names, parse_dates, tolerant_cast

DISTRIBUTION_COLUMNS = ("Category", "Segment", "Region")
STAT_COLUMNS = ("Sales", "Profit", "Quantity", "Discount")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, one BIGINT column per input column: how many values are NULL."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def value_counts(df: DataFrame, columns: Sequence[str] = DISTRIBUTION_COLUMNS) -> DataFrame:
    """(column_name, value, n) for several columns in one pass.

    ``unpivot`` expands each row into one (column, value) pair per column and the
    partial aggregate right after it collapses them map-side, so only
    #distinct-values rows per task reach the shuffle.
    """
    cols = list(columns)
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    pairs = as_text.unpivot([], cols, "column_name", "value")
    return (
        pairs.groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("column_name"), F.desc("n"), F.col("value"))
    )


STATISTICS = ("n", "mean", "stddev", "min_value", "max_value")


def _statistics(c: str) -> dict[str, Column]:
    as_double = F.col(c).cast("double")
    values = (F.count(c), exact_mean(c, 4).cast("double"), F.round(F.stddev_samp(as_double), 4), F.min(as_double), F.max(as_double))
    return dict(zip(STATISTICS, values))


def describe_numeric(df: DataFrame, columns: Sequence[str] = STAT_COLUMNS) -> DataFrame:
    """Typed ``describe()``: one row per column: column_name, n, mean, stddev,
    min_value, max_value.

    All statistics of all columns come from one aggregate; the single result row is
    then exploded into one row per column. Mean is exact (DECIMAL) to 4 places,
    stddev (sample) rounded to 4 places.
    """
    cols = list(columns)
    one = df.agg(*[a.alias(f"{c}__{s}") for c in cols for s, a in _statistics(c).items()])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in STATISTICS])
            for c in cols
        ]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def schema_report(df: DataFrame) -> DataFrame:
    """(column, type) rows from the schema (metadata only, no data is read)."""
    spark = df.sparkSession
    return spark.createDataFrame(list(df.dtypes), "column string, type string")


def cleaning_summary(typed: DataFrame) -> DataFrame:
    """rows_before / rows_after / removed for the cleaning rule, in one pass."""
    kept = keep_predicate(typed)
    return typed.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_after")
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))


# ------------------------------------------------------------------ the whole report in one scan
def report_groups(df: DataFrame, kept: Column | None = None, distributions: Sequence[str] = DISTRIBUTION_COLUMNS,
                  statistics: Sequence[str] = STAT_COLUMNS) -> DataFrame:
    """Everything the report shows, from ONE scan of ``df``: GROUPING SETS give a row per value of
    each distribution column and one row over all, with every count and statistic. ``kept``
    marks the rows that cleaning keeps. Only #values rows per task reach the shuffle."""
    dims, stats = list(distributions), list(statistics)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null__{c}") for c in df.columns]
    aggs += [a.alias(f"{c}__{s}") for c in stats for s, a in _statistics(c).items()]
    aggs.append((F.count_if(kept) if kept is not None else F.count(F.lit(1))).alias("kept"))
    return df.groupingSets([*[[c] for c in dims], []], *dims).agg(F.grouping_id().alias("_gid"), *aggs)


def report_from_groups(groups: DataFrame, schema: StructType, distributions: Sequence[str] = DISTRIBUTION_COLUMNS,
                       statistics: Sequence[str] = STAT_COLUMNS) -> dict[str, DataFrame]:
    """The report's parts from a ``report_groups`` result (#values rows, live or stored);
    ``schema`` is that of the reported rows."""
    dims = list(distributions)
    total = groups.filter(F.col("_gid") == (1 << len(dims)) - 1)
    counted = groups.filter(F.col("_gid") != (1 << len(dims)) - 1)
    # the grouping id has a 0 bit for the one column that a row is grouped by (first column: highest bit)
    own = [(F.col("_gid").bitwiseAND(1 << (len(dims) - 1 - k)) == 0, c) for k, c in enumerate(dims)]
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for is_own, c in own:
        name = F.when(is_own, F.lit(c)).otherwise(name)
        value = F.when(is_own, F.col(c).cast("string")).otherwise(value)
    columns = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                                 (F.col("n") - F.col(f"null__{f.name}")).alias("non_null")) for f in schema.fields])
    stats = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in STATISTICS]) for c in statistics])
    return {
        "row_count": total.select(F.col("n").alias("row_count")),
        "schema": total.select(F.explode(columns).alias("c")).select("c.*"),
        "null_counts": total.select(*[F.col(f"null__{f.name}").alias(f.name) for f in schema.fields]),
        "value_counts": counted.select(name.alias("column_name"), value.alias("value"), "n").orderBy("column_name", F.desc("n"), "value"),
        "describe": total.select(F.explode(stats).alias("r")).select("r.*"),
        "cleaning_summary": total.select(F.col("n").alias("rows_before"), F.col("kept").alias("rows_after"), (F.col("n") - F.col("kept")).alias("removed")),
    }


def report_rows(raw: DataFrame) -> tuple[DataFrame, Column]:
    """The rows a report is about — cast, with their dates as the text they came as — and which of
    them cleaning keeps (it parses the dates)."""
    rows = tolerant_cast(normalise_names(raw))
    kept = keep_predicate(parse_dates(rows))
    dated = F.try_to_date(F.col("Order_Date"), ORDER_DATE_FORMAT).isNotNull()
    return rows, kept & dated
