"""Compare registered queries with their SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def difference(df, db, sql: str, show: int = 3) -> str | None:
    """None if both give the same columns and the same bag of rows."""
    result = db.execute(sql)
    theirs = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(theirs):
        return f"columns {sorted(df.columns)} != {sorted(theirs)}"
    order = sorted(theirs)
    at = [theirs.index(c) for c in order]
    want = [tuple(_cell(r[i]) for i in at) for r in result.fetchall()]
    got = [tuple(_cell(r[c]) for c in order) for r in df.collect()]
    want.sort(key=repr)
    got.sort(key=repr)
    if len(want) != len(got):
        return f"{len(got)} rows, SQL has {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ in {order}, e.g. {wrong[:show]}"
    types = [type(v) for v in next(iter(want), ())], [type(v) for v in next(iter(got), ())]
    if any(a is not b for a, b in zip(*types) if type(None) not in (a, b)):
        return f"types differ in {order}: {types}"
    return None
