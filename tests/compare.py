"""Run a query and its reference SQL and compare the rows without order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool):
        return f"{float(value):.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, run, sql):
    """None if equal, else a message."""
    df = run(spark, folder)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in found.description], found.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, e) for g, e in zip(got, want) if g != e]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}"[:1500] if bad else None
