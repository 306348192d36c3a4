"""Runs a query and its SQL twin and compares names, and rows as multisets."""

from __future__ import annotations

import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, con, build, sql, sf_dir) -> list[str]:
    got = build(spark, sf_dir)
    want = con.execute(sql)
    want_names = [c[0] for c in want.description]
    if sorted(got.columns) != sorted(want_names):
        return [f"columns {sorted(got.columns)} != {sorted(want_names)}"]
    left, right = rows_of(got.columns, got.collect()), rows_of(want_names, want.fetchall())
    if left == right:
        return []
    return [
        f"rows {left.total()} vs {right.total()}",
        f"only spark: {list((left - right).items())[:3]}",
        f"only sql: {list((right - left).items())[:3]}",
    ]
