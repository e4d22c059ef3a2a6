"""Spark's and DuckDB's rows of a query, compared value by value."""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import datetime
from decimal import Decimal

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


def plain(v):
    if v is None or isinstance(v, (str, bool, int)):
        return v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark, query, sql: str, sf_dir: str) -> str:
    """Empty where both agree in columns and rows."""
    df = query(spark, sf_dir)
    con = duck(sf_dir)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = rows_of(df.columns, df.collect()), rows_of(names, found.fetchall())
    if a == b:
        return ""
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return f"{sum(a.values())} and {sum(b.values())} rows; {len(only_a)} only in Spark, {len(only_b)} only in DuckDB: {sorted(df.columns)} {str(only_a[:2])[:700]} ||| {str(only_b[:2])[:700]}"
