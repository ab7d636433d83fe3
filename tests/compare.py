"""Compare a query with its SQL: same rows in any order, columns sorted by name."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def text(v):
        if v is None or v is pd.NaT or v is pd.NA:
            return None
        if isinstance(v, float):
            return None if v != v else repr(v)
        if isinstance(v, (pd.Timestamp,)) or hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, bool):
            return str(v)
        if hasattr(v, "item"):
            return text(v.item())
        return str(v)

    def number(t):
        return repr(float(t)) if t and t.lstrip("-").isdigit() else t

    return sorted((tuple(number(text(v)) for v in row) for row in df.itertuples(index=False)), key=str)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} and {sorted(sql_rows.columns)}"
    a, b = _plain(spark_rows), _plain(sql_rows)
    if a == b:
        return None
    only_a, only_b = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
    return f"{len(a)} and {len(b)} rows; only in Spark {only_a}; only in SQL {only_b}"
