"""Run a registered query and its reference SQL on the same folder and compare the rows."""

from __future__ import annotations

import collections
import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("null",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("float", round(v, 5) + 0.0)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("time", str(v))
    return ("text", str(v))


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    order = sorted(names)
    mine = [tuple(cell(r[c]) for c in order) for r in spark_df.collect()]
    pos = [names.index(c) for c in order]
    theirs = [tuple(cell(r[i]) for i in pos) for r in want]
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    a, b = collections.Counter(mine), collections.Counter(theirs)
    if a != b:
        only_a, only_b = sorted((a - b).elements(), key=str), sorted((b - a).elements(), key=str)
        return f"{len(only_a)} rows differ, columns {order}\n  spark {only_a[:3]}\n  sql   {only_b[:3]}"
    return None
