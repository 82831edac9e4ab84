"""Compare a Spark result with DuckDB SQL on the same parquet tables:
row count, column names, and an order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

from topicscope.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def compare(spark_df, con, sql: str) -> dict:
    cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(cols)) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows_raw = res.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(_norm(r[i]) for i in order) for r in d_rows_raw]
    out = {"spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(cols) == sorted(d_cols),
           "spark_cols": cols, "duck_cols": d_cols}
    cs, cd = Counter(s_rows), Counter(d_rows)
    out["values_match"] = cs == cd
    if cs != cd:
        out["only_spark"] = list((cs - cd).elements())[:3]
        out["only_duck"] = list((cd - cs).elements())[:3]
    return out
