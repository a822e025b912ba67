"""Run registered queries and their SQL side by side and compare them as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    mine = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = cur.fetchall()
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if a != b:
        return f"{len(mine)} vs {len(theirs)} rows; only here {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
    if not mine:
        return "no rows"
    return None
