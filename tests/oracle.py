"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return _by_name(names, cur.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _by_name(df.columns, [tuple(r) for r in df.collect()])


def _by_name(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(
        (tuple(_value(row[i]) for i in order) for row in rows), key=repr
    )


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def compare(spark, con, sf_dir: str, query, sql: str) -> tuple[str, float]:
    """An empty text if equal, else what differs; and Spark's seconds."""
    start = time.time()
    got_names, got = spark_rows(query(spark, sf_dir))
    seconds = time.time() - start
    want_names, want = oracle_rows(con, sql)
    if got_names != want_names:
        return f"columns {got_names} against {want_names}", seconds
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}", seconds
    for g, w in zip(got, want):
        if g != w or [type(a) for a in g] != [type(b) for b in w]:
            return f"row {g} against {w}", seconds
    return "", seconds
