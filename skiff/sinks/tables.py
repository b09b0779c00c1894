"""Publishing marts: catalog tables, files or JDBC — always written by executors.

The reference collected every mart to the driver and inserted rows in batches of
1,000; here each task writes its own partition of the result.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
    IntegerType, LongType, ShortType, StringType, StructType, TimestampNTZType, TimestampType,
)

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")
JDBC_BATCH_SIZE = 1000


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def setup_namespace(spark: SparkSession, database: str, location: str | None = None, select: bool = True) -> None:
    """Idempotent namespace creation (its tables under ``location``, if given) + selection."""
    at = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}{at}")
    if select:
        spark.catalog.setCurrentDatabase(database)


def publish_mart(df: DataFrame, name: str, database: str | None = None, mode: str = "overwrite") -> str:
    """Replace (or append to) a catalog table with ``df``."""
    table = f"{_ident(database)}.{_ident(name)}" if database else _ident(name)
    df.write.mode(mode).saveAsTable(table)
    return table


def publish_marts(marts: dict[str, DataFrame], database: str | None = None) -> list[str]:
    return [publish_mart(df, name, database) for name, df in marts.items()]


def swap_mart(df: DataFrame, name: str, database: str, keep: int = 2) -> str:
    """Replace a published mart without a moment in which it is missing or half written.

    Each load writes a table of its own (``<name>__v<id>``); once that is complete the view
    ``<name>``, which readers query, is pointed at it in one catalog change. The newest ``keep``
    versions stay, so that a query planned before the change still finds its files."""
    spark, view = df.sparkSession, f"{_ident(database)}.{_ident(name)}"
    known = sorted(t.name for t in spark.catalog.listTables(database) if t.name.lower().startswith(f"{name.lower()}__v"))
    number = int(known[-1].rsplit("__v", 1)[1].split("_")[0]) + 1 if known else 1
    version = f"{name}__v{number:08d}_{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").saveAsTable(f"{database}.{version}")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {database}.{version}")
    for old in known[: max(0, len(known) + 1 - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
    return view


def swap_marts(marts: dict[str, DataFrame], database: str) -> list[str]:
    return [swap_mart(df, name, database) for name, df in marts.items()]


def warehouse_type(dt: DataType, text_length: int = 500) -> str:
    """Spark type → warehouse column type (BIGINT for counts, exact DECIMAL money)."""
    if isinstance(dt, StringType):
        return f"VARCHAR({text_length})"
    if isinstance(dt, (DoubleType, FloatType)):
        return "FLOAT"
    if isinstance(dt, LongType):
        return "BIGINT"
    if isinstance(dt, (IntegerType, ShortType, ByteType)):
        return "INTEGER"
    if isinstance(dt, DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, BooleanType):
        return "BOOLEAN"
    if isinstance(dt, DateType):
        return "DATE"
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return "TIMESTAMP"
    return f"VARCHAR({text_length})"


def column_types_ddl(schema: StructType, text_length: int = 500) -> str:
    """Value for the JDBC writer's ``createTableColumnTypes`` option."""
    return ", ".join(f"{f.name} {warehouse_type(f.dataType, text_length)}" for f in schema.fields)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_size: int = JDBC_BATCH_SIZE,
    properties: dict[str, str] | None = None,
) -> None:
    """Replace-table load over JDBC: the table is (re)created from the schema and
    each task inserts its rows in batches of ``batch_size``."""
    props = {"batchsize": str(batch_size), **(properties or {})}
    (
        df.write.mode(mode)
        .option("createTableColumnTypes", column_types_ddl(df.schema))
        .jdbc(url, table, properties=props)
    )
