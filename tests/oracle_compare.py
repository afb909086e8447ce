"""Compare a registered Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from jobstar.sources.tables import TABLE_NAMES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql):
    s_cols, s_rows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    d_cols, d_rows = rows_of(rel.columns, rel.fetchall())
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    if not problems and s_rows != d_rows:
        ds, ss = set(d_rows), set(s_rows)
        diff_s = [r for r in s_rows if r not in ds][:3]
        diff_d = [r for r in d_rows if r not in ss][:3]
        problems.append(f"values differ: spark-only={diff_s} duck-only={diff_d}")
    return problems, len(s_rows)
