"""Comparison of a query with its SQL on the same parquet tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows, else a description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    expected = Counter(tuple(repr(r[i]) for i in at) for r in result.fetchall())
    got = Counter(tuple(repr(v) for v in row) for row in df.select(*order).collect())
    if got == expected:
        return None
    extra, missing = list((got - expected).items())[:3], list((expected - got).items())[:3]
    return f"rows {sum(got.values())} against {sum(expected.values())}; only here {extra}; only SQL {missing}"
