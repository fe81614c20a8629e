"""Order-insensitive comparison of a Spark result with SQL run by DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def differences(df, con, sql: str) -> tuple[list, list, int]:
    """Rows only Spark has, rows only the SQL has, and the number of rows."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    wanted = Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    got = Counter(tuple(plain(v) for v in r) for r in df.collect())
    return list((got - wanted).elements()), list((wanted - got).elements()), sum(got.values())
