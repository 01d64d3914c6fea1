"""Compare a Spark result with DuckDB SQL on the same parquet tables.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (columns sorted by name, rows sorted).
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from eventide.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
    df = df.astype(object).where(df.notna(), None)
    return df.sort_values(list(df.columns), key=lambda s: s.map(repr)).reset_index(drop=True)


def compare(spark_df, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    got = spark_df.toPandas()
    want = con.execute(sql).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns differ: {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return False, f"row count differs: spark {len(got)} vs oracle {len(want)}"
    g, w = _norm(got), _norm(want)
    for c in g.columns:
        a, b = g[c].tolist(), w[c].tolist()
        for i, (x, y) in enumerate(zip(a, b)):
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6):
                continue
            return False, f"column {c} row {i}: spark {x!r} vs oracle {y!r}"
    return True, f"{len(got)} rows match"
