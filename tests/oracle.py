"""Compare a registered query with its SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql: str, sf_dir: str) -> tuple[int, str]:
    """(rows, '' or what differs)."""
    got = fn(spark, sf_dir)
    names = got.columns
    mine = _rows(names, [tuple(r) for r in got.collect()])
    cursor = con.execute(sql)
    theirs_names = [d[0] for d in cursor.description]
    theirs = _rows(theirs_names, cursor.fetchall())
    if sorted(names) != sorted(theirs_names):
        return len(mine), f"columns {sorted(names)} vs {sorted(theirs_names)}"
    if len(mine) != len(theirs):
        return len(mine), f"rows {len(mine)} vs {len(theirs)}; only here {[r for r in mine if r not in theirs][:2]!r:.600}; only there {[r for r in theirs if r not in mine][:2]!r:.600}"
    for a, b in zip(mine, theirs):
        if a != b:
            return len(mine), f"{a!r:.500} vs {b!r:.500}"
    return len(mine), ""
