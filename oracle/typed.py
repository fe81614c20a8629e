"""Wraps checking SQL so that its columns have the same plain types as the Spark side.

Column types are asked from DuckDB itself over empty tables of the benchmark schema.
"""

from __future__ import annotations

import duckdb

SCHEMA = """
create table orders(o_orderkey bigint, o_custkey bigint, o_orderstatus varchar, o_totalprice double, o_orderdate timestamp, o_orderpriority varchar);
create table lineitem(l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber integer, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag varchar, l_linestatus varchar, l_shipdate timestamp);
create table customer(c_custkey bigint, c_name varchar, c_nationkey integer, c_acctbal double, c_mktsegment varchar);
create table part(p_partkey bigint, p_name varchar, p_brand varchar, p_type varchar, p_size integer, p_retailprice double);
create table supplier(s_suppkey bigint, s_name varchar, s_nationkey integer, s_acctbal double);
create table nation(n_nationkey integer, n_name varchar, n_regionkey integer);
create table region(r_regionkey integer, r_name varchar);
create table events(event_id bigint, ts timestamp, user_id bigint, event_type varchar, value double, props varchar);
"""

WHOLE = {"TINYINT", "SMALLINT", "INTEGER", "HUGEINT", "UINTEGER", "UBIGINT", "UTINYINT", "USMALLINT", "UHUGEINT"}


def plain(name: str, kind: str) -> str:
    quoted = f'"{name}"'
    if kind.startswith("TIMESTAMP"):
        return f"strftime({quoted}, '%Y-%m-%dT%H:%M:%S') as {quoted}"
    if kind == "DATE":
        return f"strftime({quoted}, '%Y-%m-%d') as {quoted}"
    if kind in WHOLE:
        return f"cast({quoted} as bigint) as {quoted}"
    if kind.startswith("DECIMAL") or kind == "FLOAT":
        return f"cast({quoted} as double) as {quoted}"
    return quoted


def with_plain_types(texts: dict[str, str]) -> dict[str, str]:
    con = duckdb.connect()
    con.execute(SCHEMA)
    out = {}
    for name, text in texts.items():
        try:
            described = con.execute(f"describe {text}").fetchall()
        except duckdb.Error as e:
            raise ValueError(f"checking SQL of {name}: {e}") from e
        columns = ", ".join(plain(row[0], row[1]) for row in described)
        out[name] = f"select {columns} from (\n{text}\n) result"
    con.close()
    return out
