"""Run a registered query and its SQL over the same tables and compare the results as multisets."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, datetime.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, datetime.date):
        return ("d", v.isoformat())
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        return ("f", float(f"{v:.9g}") + 0.0)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, str):
        return ("s", v)
    return (type(v).__name__, str(v))


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got_cols, got = _bag(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = _bag([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; only here {list((got - want).items())[:3]};"
            f" only in SQL {list((want - got).items())[:3]}"
        )
    return None
