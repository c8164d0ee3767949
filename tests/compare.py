"""Order-insensitive comparison of a Spark frame with a DuckDB query."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None else f"{type(value).__name__}:{value}"


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str:
    """Empty if equal, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    got = rows_of(df.columns, df.collect())
    if got == expected:
        return ""
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows vs {sum(expected.values())}; "
        f"{sum(extra.values())} unexpected e.g. {list(extra)[:2]}; {sum(missing.values())} missing e.g. {list(missing)[:2]}"
    )
