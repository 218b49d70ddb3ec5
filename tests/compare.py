"""Runs queries beside their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import os

import duckdb


def connect(sf_dir: str):
    c = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{sf_dir}/{f}')")
    return c


def rows(frame) -> list[tuple]:
    names = sorted(frame.columns)

    def plain(x):
        if x is None or str(x) in ("<NA>", "NaT") or x != x:
            return "null"
        return f"{float(x):.6g}" if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)

    return sorted(tuple(plain(x) for x in r) for r in frame[names].itertuples(index=False)) + [tuple(names)]


def same(spark, name: str, query, sql: str, sf_dir: str) -> bool:
    return rows(query(spark, sf_dir).toPandas()) == rows(connect(sf_dir).execute(sql).df())
