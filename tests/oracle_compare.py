"""Compare a Spark query with its DuckDB oracle: row count, column names and an
order-insensitive multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    sp_cols = spark_df.columns
    sp_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    dk_cols = [d[0] for d in rel.description]
    dk_rows = rel.fetchall()
    if sorted(sp_cols) != sorted(dk_cols):
        return False, f"columns differ: spark={sorted(sp_cols)} duck={sorted(dk_cols)}"
    if len(sp_rows) != len(dk_rows):
        return False, f"row count differs: spark={len(sp_rows)} duck={len(dk_rows)}"
    order = sorted(sp_cols)
    si = [sp_cols.index(c) for c in order]
    di = [dk_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in sp_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in dk_rows), key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row (cols {order}):\n spark={x}\n duck ={y}"
    return True, f"{len(a)} rows match"
