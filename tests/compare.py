"""Order-insensitive comparison of a Spark result with the SQL answer."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and rows, else a short description."""
    names, rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_names, want = canonical([d[0] for d in rel.description], rel.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(rows) != len(want):
        return f"rows {len(rows)} != {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    return f"{len(bad)} of {len(rows)} rows differ, first: {bad[0]}" if bad else None
