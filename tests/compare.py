"""Run a query in Spark and its SQL counterpart in DuckDB and compare all values."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return repr(float(value))
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def difference(spark_side, duck_side) -> str | None:
    (s_cols, s_rows), (d_cols, d_rows) = spark_side, duck_side
    if s_cols != d_cols:
        return f"columns {s_cols} != {d_cols}"
    if len(s_rows) != len(d_rows):
        return f"{len(s_rows)} rows != {len(d_rows)}"
    bad = [(s, d) for s, d in zip(s_rows, d_rows, strict=True) if s != d]
    return f"{len(bad)} of {len(s_rows)} rows differ, e.g.\n  {s_cols}\n  {bad[0][0]}\n  {bad[0][1]}" if bad else None
