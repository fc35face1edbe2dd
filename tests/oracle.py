"""Runs a query and its DuckDB SQL on the same tables and compares rows as sets with repeats."""

from __future__ import annotations

from decimal import Decimal

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if isinstance(value, list | tuple):
        return tuple(_plain(v) for v in value)
    return float(value) if isinstance(value, Decimal) else value


def both(spark, query, sql: str, folder: str) -> tuple[list, list]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = query(spark, folder)
    columns = sorted(df.columns)
    mine = [tuple(_plain(v) for v in r) for r in df.select(*(f"`{c}`" for c in columns)).collect()]
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    theirs = [tuple(_plain(r[names.index(c)]) for c in columns) for r in result.fetchall()]
    key = lambda r: repr([(v is None, v) for v in r])
    return sorted(mine, key=key), sorted(theirs, key=key)
