"""Spark vs DuckDB comparison used by the tests (mirrors the driver's check)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return len(rows), hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_cols": sorted(s_cols), "duck_cols": sorted(d_cols)}
    sn, sh, sl = digest(s_cols, s_rows)
    dn, dh, dl = digest(d_cols, d_rows)
    out.update(rows=(sn, dn), match=(sorted(s_cols) == sorted(d_cols) and sh == dh))
    if not out["match"]:
        ss, ds = set(sl), set(dl)
        out["only_spark"] = sorted(ss - ds)[:3]
        out["only_duck"] = sorted(ds - ss)[:3]
    return out
