"""Runs a registered query and its SQL and compares rows as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in records)


def both(spark, con, sf, query, sql):
    df = query(spark, sf)
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    names = [r[0] for r in con.execute(f"DESCRIBE {sql}").fetchall()]
    theirs = rows(names, con.execute(sql).fetchall())
    return ours, theirs
