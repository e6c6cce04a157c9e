"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    if isinstance(x, (list, tuple)):
        return tuple(_cell(v) for v in x)
    return x


def rows(names: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


def differences(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty if both give the same rows and column names."""
    df = query(spark, sf_dir)
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(rel.columns)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(rel.columns, rel.fetchall())
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
        return f"{len(a)} and {len(b)} rows; only here {only_a}; only in SQL {only_b}"
    return ""
