"""Run a registered query and its oracle SQL on the same tables and compare rows exactly."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from carelake.plans.domain import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and its oracle; empty when they agree."""
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    out = []
    if ours[0] != theirs[0]:
        out.append(f"columns {ours[0]} != {theirs[0]}")
    if len(ours[1]) != len(theirs[1]):
        out.append(f"rows {len(ours[1])} != {len(theirs[1])}")
    if not out and ours[1] != theirs[1]:
        a, b = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
        out.append(f"{len(a)} rows differ, spark {sorted(a)[:2]} oracle {sorted(b)[:2]}")
    return out
