"""Comparing a registered query with its SQL twin."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(folder: str = FOLDER) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = rows_of(names, cursor.fetchall())
    got = rows_of(frame.columns, frame.collect())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows, want {sum(want.values())}; "
        f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
    )
