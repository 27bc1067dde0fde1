"""Compares queries with their SQL on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        where = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{where}')")
    return con


def differences(df, sql: str, sf_dir: str) -> list[str]:
    """What differs, empty if nothing does."""
    got = [r.asDict() for r in df.collect()]
    rel = tables(sf_dir).sql(sql)
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    out = []
    if set(df.columns) != set(rel.columns):
        out.append(f"columns {sorted(df.columns)} and {sorted(rel.columns)}")
    else:
        names = sorted(df.columns)
        a = sorted((tuple(_plain(r[c]) for c in names) for r in got), key=repr)
        b = sorted((tuple(_plain(r[c]) for c in names) for r in want), key=repr)
        if len(a) != len(b):
            out.append(f"rows {len(a)} and {len(b)}")
        off = [(x, y) for x, y in zip(a, b) if not all(p == q or isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=2e-5) for p, q in zip(x, y))]
        if off and not out:
            out.append(f"{len(off)} of {len(a)} rows, such as {off[0]}")
        if not got:
            out.append("no rows")
    return out
