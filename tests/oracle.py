"""Runs a query and its SQL and compares columns, types and every value."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        raise TypeError("decimal in a result")
    if isinstance(v, float):
        return ("f", repr(v + 0.0))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return (type(v).__name__, str(v))


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    rel = con.sql(sql)
    want_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got_types = {c: KINDS.get(t, t) for c, t in df.dtypes}
    out = []
    if want_types != got_types:
        out.append(f"types: want {want_types}, got {got_types}")
    cols = sorted(got_types)
    if sorted(want_types) != cols:
        return out
    order = [list(rel.columns).index(c) for c in cols]
    want = sorted(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())
    got = sorted(tuple(_plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if len(want) != len(got):
        out.append(f"rows: want {len(want)}, got {len(got)}")
    bad = [(w, g) for w, g in zip(want, got) if w != g]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out
