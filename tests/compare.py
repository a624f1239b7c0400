"""Run a query and its SQL side by side."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def rows_of_sql(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(r[i] for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def rows_of_frame(df):
    names = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    return names, sorted(rows, key=_key)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else a short account."""
    names, got = rows_of_frame(df)
    sql_names, want = rows_of_sql(con, sql)
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; first {got[:1]} / {want[:1]}"
    wrong = [(a, b) for a, b in zip(got, want) if not _same(a, b)]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[0]} in columns {names}"
    return None if got else "no rows"


def _same(a, b) -> bool:
    return len(a) == len(b) and all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
        for x, y in zip(a, b)
    )
