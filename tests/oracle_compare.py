"""Compare a Spark result with DuckDB SQL on the same parquet tables."""

from __future__ import annotations

import math
import os

import duckdb

from scorewell.plans.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    assert sorted(s_cols) == sorted(d_cols), (sorted(s_cols), sorted(d_cols))
    assert len(s_rows) == len(d_rows), (len(s_rows), len(d_rows))
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    a, b = sorted(s_rows, key=key), sorted(d_rows, key=key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    assert not bad, bad[:5]
