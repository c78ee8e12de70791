"""Compare a query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(d)):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{d}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def difference(df, con, sql: str) -> str | None:
    """None when rows and types agree, else what differs."""
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = dict(df.dtypes)
    if set(mine) != set(described):
        return f"columns {sorted(mine)} vs {sorted(described)}"
    wrong = {c: (t, described[c]) for c, t in mine.items() if TYPES.get(t, t) != described[c]}
    columns = sorted(mine)
    picked = ", ".join(f'"{c}"' for c in columns)
    left = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    right = sorted(tuple(plain(v) for v in r)
                   for r in con.execute(f"SELECT {picked} FROM ({sql})").fetchall())
    if left != right:
        lost = [r for r in right if r not in set(left)][:2]
        extra = [r for r in left if r not in set(right)][:2]
        return f"{len(left)} vs {len(right)} rows; columns {columns}; lost {lost}; extra {extra}"
    if wrong:
        return f"types {wrong}"
    return None
