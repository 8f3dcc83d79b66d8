"""Side-by-side check of a Spark result against DuckDB oracle SQL (like the driver's gate)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from leadflow.sources.testdata import RAW_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff (cols {sorted(s_cols)}):\n spark={x}\n duck ={y}"
    return True, f"{len(a)} rows match"


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def type_mismatches(spark_df, con, sql: str) -> list:
    """Columns whose Spark type does not map onto the oracle's DuckDB type."""
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, t, duck_types.get(c)) for c, t in spark_df.dtypes if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)]
