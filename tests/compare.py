"""Run a registered query in Spark and its SQL in DuckDB on the same files and compare."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (float(v) + 0.0)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "is_finite"):
        return float(v)
    return str(v)


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in (x.asDict() for x in df.collect()))


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def differences(df, con, sql):
    """Empty when both agree, else a short description."""
    names, got = spark_rows(df)
    wanted_names, wanted = duck_rows(con, sql)
    if names != wanted_names:
        return f"columns differ: {sorted(set(names) ^ set(wanted_names))}"
    if got != wanted:
        extra, lost = list((got - wanted).items())[:2], list((wanted - got).items())[:2]
        detail = ""
        if extra and lost:
            detail = [(n, a, b) for n, a, b in zip(names, extra[0][0], lost[0][0]) if a != b][:6]
        return f"rows differ ({sum(got.values())} vs {sum(wanted.values())}, {sum((got - wanted).values())} wrong) spark {extra} sql {lost} {detail}"[:1500]
    return ""
