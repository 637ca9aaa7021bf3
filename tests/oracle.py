"""Compare a Spark result with its SQL in DuckDB: names, row count, values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    flat = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(flat, key=lambda r: tuple(str(v) for v in r))


def differences(df, con, sql: str) -> list[str]:
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_names, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    found = []
    if len(got) != len(want):
        found.append(f"{len(got)} rows, SQL has {len(want)}")
    for left, right in zip(got, want):
        if left != right:
            found.append(f"{left} != {right}")
            break
    return found
