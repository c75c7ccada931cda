"""Run a registered query and its SQL counterpart and compare the rows, whatever their order."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    """A value both engines write the same way; integers and floats stay apart."""
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, Decimal)):
        f = float(v)
        if math.isnan(f) or math.isinf(f):
            return str(f)
        return f"f{round(f, 6) + 0.0:.6f}"
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return f"{type(v).__name__}:{v}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cur = con.execute(sql)
    return normal([d[0] for d in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    """What differs, or None."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for g, w in zip(got[1], want[1], strict=True):
        if g != w:
            return f"first differing row: {g} != {w}"
    return None
