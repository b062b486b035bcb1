"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(df, con, sql):
    """(row count, list of differences)."""
    spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    duck_rows = rows_of(names, cur.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows {len(spark_rows)} != {len(duck_rows)}")
    a, b = {}, {}
    for r in spark_rows:
        a[r] = a.get(r, 0) + 1
    for r in duck_rows:
        b[r] = b.get(r, 0) + 1
    left = [r for r in a if a[r] != b.get(r, 0)]
    right = [r for r in b if b[r] != a.get(r, 0)]
    if left or right:
        problems.append(f"{len(left)} / {len(right)} differing rows")
        problems += [f"  spark {r}" for r in left[:3]] + [f"  duck  {r}" for r in right[:3]]
    return len(spark_rows), problems
