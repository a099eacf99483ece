"""Compare a Spark query with its DuckDB oracle (used by the tests)."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "benchmark", "labels"]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con, sql: str) -> tuple[bool, str]:
    """Order-insensitive comparison of column names and values."""
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        return False, f"values differ: spark-only={only_s} oracle-only={only_d}"
    return True, f"{len(s_rows)} rows"
