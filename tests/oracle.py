"""Run a query and its SQL on the same tables and compare them value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if v is None:
        return None
    if hasattr(v, "asDict"):
        return tuple(_plain(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(_plain(x) for x in v.values())
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences in words; empty when both agree exactly."""
    got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    kinds = {n: t for n, t in df.dtypes}
    sql_kinds = {d[0]: str(d[1]) for d in cur.description}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    bad = {n: (kinds[n], sql_kinds[n]) for n in kinds if kinds[n] in same and same[kinds[n]] != sql_kinds[n]}
    if bad:
        out.append(f"types {bad}")
    if len(got) != len(want):
        return out + [f"rows {len(got)} against {len(want)}; first {got[:2]} against {want[:2]}"]
    wrong = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if wrong:
        out.append(f"{len(wrong)} of {len(got)} rows differ, first {wrong[0][0]} against {wrong[0][1]}")
    return out
