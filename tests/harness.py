"""Runs a registered query and its oracle and compares sorted row sets."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def sort_key(row):
    return tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in row)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=sort_key)


def oracle_rows(con, text):
    cur = con.execute(text)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], sorted(rows, key=sort_key)


def difference(df, con, text, limit=3):
    """Empty string when equal, else a short report."""
    c1, r1 = spark_rows(df)
    c2, r2 = oracle_rows(con, text)
    if c1 != c2:
        return f"columns {c1} vs {c2}"
    if len(r1) != len(r2):
        return f"rows {len(r1)} vs {len(r2)}; {r1[:1]} {r2[:1]}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    if bad:
        detail = []
        for a, b in bad[:limit]:
            detail.append(str([(c, x, y) for c, x, y in zip(c1, a, b) if x != y]))
        return f"{len(bad)} of {len(r1)} rows differ: " + "; ".join(detail)
    return ""
