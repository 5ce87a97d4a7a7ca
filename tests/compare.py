"""Runs a query on Spark and its statement on DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from trailsight.plans.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return int(value) if value.is_integer() else value
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def key(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(plain(v) for v in r) for r in frame.select(*names).collect()), key=key)


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    order = sorted(range(len(cols)), key=lambda n: cols[n])
    rows = [tuple(plain(r[n]) for n in order) for r in rel.fetchall()]
    return [cols[n] for n in order], sorted(rows, key=key)


def difference(frame, con, sql) -> str | None:
    """None when equal, else what differs."""
    names, ours = spark_rows(frame)
    other, theirs = duck_rows(con, sql)
    if names != other:
        return f"columns {names} vs {other}"
    if ours == theirs:
        return None
    only = [r for r in ours if r not in set(theirs)][:3]
    missing = [r for r in theirs if r not in set(ours)][:3]
    return f"rows {len(ours)} vs {len(theirs)}; only Spark {only}; only SQL {missing}"
