"""Runs a registered query and its SQL on the same folder and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

from bindings.derived import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(folder, t)}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v == int(v) else float(f"{v:.9g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([_plain(x) for x in v])
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, fn, sql):
    """(message or None, number of rows)."""
    df = fn(spark, folder)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}", len(got)
    if got != want:
        bad = next((i for i, (a, b) in enumerate(zip(got, want)) if a != b), min(len(got), len(want)))
        return (f"rows {len(got)} vs {len(want)}; first difference\n   spark {got[bad] if bad < len(got) else None!r}"
                f"\n   sql   {want[bad] if bad < len(want) else None!r}"), len(got)
    return None, len(got)
