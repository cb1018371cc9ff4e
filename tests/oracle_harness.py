"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (columns sorted by name).
"""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "nan")
        return (1, repr(round(v, 9)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    return (1, str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols, "oracle_cols": d_cols,
    }
    out["values_match"] = out["cols_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    out["ok"] = out["values_match"] and len(s_rows) == len(d_rows)
    if not out["ok"] and out["cols_match"]:
        a, b = set(rows_of(s_cols, s_rows)), set(rows_of(d_cols, d_rows))
        out["only_spark"] = sorted(a - b)[:5]
        out["only_oracle"] = sorted(b - a)[:5]
    return out
