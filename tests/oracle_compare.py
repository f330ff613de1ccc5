"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import datetime
import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return f"{type(v).__name__}:{v}"


def compare(spark, con, folder, fn, sql):
    """None when both agree, else a description of the difference."""
    start = time.time()
    df = fn(spark, folder)
    rows = df.collect()
    took = time.time() - start
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return took, f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    a = sorted("\x1f".join(cell(r[c]) for c in order) for r in rows)
    b = sorted("\x1f".join(cell(r[names.index(c)]) for c in order) for r in want)
    if len(a) != len(b):
        return took, f"rows {len(a)} != {len(b)}; only spark {list(set(a) - set(b))[:2]} only sql {list(set(b) - set(a))[:2]}"
    if a != b:
        return took, f"{len(a)} rows differ: spark {[x for x, y in zip(a, b) if x != y][:2]} sql {[y for x, y in zip(a, b) if x != y][:2]}"
    return took, None if rows else "no rows"
