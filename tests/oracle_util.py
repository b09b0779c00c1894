"""Spark-vs-DuckDB comparison used by the oracle tests and the check script.

Rows are compared as multisets after normalising each value to text (doubles via
``repr`` so any last-bit difference shows up)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

VIEW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in VIEW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(int(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark, con, name: str, spark_df, sql: str) -> dict:
    s_cols = spark_df.columns
    s_types = dict(spark_df.dtypes)
    s_rows = spark_df.collect()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["error"] = f"columns differ: spark={s_cols} duck={d_cols}"
        return out
    type_diff = {c: (s_types[c], d_types[c]) for c in s_cols if SPARK_TO_DUCK.get(s_types[c]) != d_types[c]}
    if type_diff:
        out["ok"] = False
        out["error"] = f"types differ: {type_diff}"
        return out
    order = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in order]
    d_idx = [d_cols.index(c) for c in order]
    s_set = sorted(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    d_set = sorted(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
    out["ok"] = s_set == d_set
    if not out["ok"]:
        s_only = [r for r in s_set if r not in set(d_set)][:3]
        d_only = [r for r in d_set if r not in set(s_set)][:3]
        out["columns"] = order
        out["spark_only"] = s_only
        out["duck_only"] = d_only
    return out
