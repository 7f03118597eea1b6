"""Compare a Spark result with the same question answered by DuckDB."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return f"dec:{value}"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: [str(v) for v in r])


def spark_table(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return table_of(names, cur.fetchall())


def difference(spark_side, duck_side) -> str | None:
    (names_a, rows_a), (names_b, rows_b) = spark_side, duck_side
    if names_a != names_b:
        return f"columns differ: {names_a} vs {names_b}"
    if len(rows_a) != len(rows_b):
        return f"row counts differ: {len(rows_a)} vs {len(rows_b)}"
    for a, b in zip(rows_a, rows_b):
        if a != b:
            return f"rows differ:\n  spark {dict(zip(names_a, a))}\n  duck  {dict(zip(names_a, b))}"
    return None
