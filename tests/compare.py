"""Compare a Spark result with DuckDB SQL on the same parquet tables:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 9))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def frame_digest(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(df), cols, h


def spark_pandas(sdf) -> pd.DataFrame:
    rows = sdf.collect()
    return pd.DataFrame([r.asDict() for r in rows], columns=sdf.columns)


def compare(sdf, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    a = spark_pandas(sdf)
    b = con.execute(sql).df()
    na, ca, ha = frame_digest(a)
    nb, cb, hb = frame_digest(b)
    out = {"rows": (na, nb), "cols_match": ca == cb, "hash_match": ha == hb, "rows_match": na == nb}
    if not (ca == cb and ha == hb):
        out["spark_cols"], out["oracle_cols"] = ca, cb
        out["a"], out["b"] = a, b
    return out
