"""Runs one registered query and its SQL counterpart on the same tables and compares whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        if value == int(value) if abs(value) < 1e15 else False:
            return repr(float(int(value)))
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return "null" if value is None else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def close(a: str, b: str) -> bool:
    if a == b:
        return True
    try:
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=2e-6)
    except ValueError:
        return False


def compare(df, con, sql: str) -> tuple[str, str]:
    """("exact" | "close" | "differs", detail)."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(names):
        return "differs", f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(expected):
        return "differs", f"rows {len(got)} vs {len(expected)}"
    a, b = rows_of(df.columns, got), rows_of(names, expected)
    if a == b:
        return "exact", f"{len(a)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if all(all(close(p, q) for p, q in zip(x, y)) for x, y in bad):
        return "close", f"{len(bad)} of {len(a)} rows differ in the last digit: {bad[0]}"
    return "differs", f"{len(bad)} of {len(a)} rows: spark {bad[0][0]} sql {bad[0][1]}"
