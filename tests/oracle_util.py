"""Spark-vs-DuckDB comparison in the driver's manner: row count, column
names (sorted), and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

import duckdb

from quire.sources.tables import DRIVER_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def table_digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], lines


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    sc, sl = table_digest(s_cols, s_rows)
    dc, dl = table_digest(d_cols, d_rows)
    h = lambda lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sc == dc,
        "hash_match": sc == dc and h(sl) == h(dl),
        "spark_cols": sc,
        "oracle_cols": dc,
    }
    if not out["hash_match"]:
        only_s = sorted(set(sl) - set(dl))[:3]
        only_d = sorted(set(dl) - set(sl))[:3]
        out["only_spark"] = [x[:300] for x in only_s]
        out["only_oracle"] = [x[:300] for x in only_d]
    return out
