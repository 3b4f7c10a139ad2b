"""Compare a query with its DuckDB twin, value by value, in any row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if hasattr(x, "quantize"):
        return float(f"{float(x):.9g}")
    return x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def differences(spark, sf_dir: str, query, sql: str) -> str:
    df = query(spark, sf_dir)
    names, rows = oracle(sf_dir, sql)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(names, rows)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ: {bad[:2]}" if bad else ""
