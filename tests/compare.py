"""Compare queries with their oracle SQL in DuckDB: columns, number of rows, values in any order."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with the input tables as views."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    if hasattr(v, "item"):
        return _plain(v.item())
    return [_plain(x) for x in v] if isinstance(v, (list, tuple)) else v


def rows(table) -> list[tuple]:
    """Rows of an arrow table, columns by name, sorted."""
    names = sorted(table.column_names)
    data = [tuple(_plain(v) for v in r) for r in zip(*(table[n].to_pylist() for n in names))]
    return sorted(data, key=repr)


def difference(spark_table, duck_table) -> str:
    """What differs, or nothing."""
    a, b = sorted(spark_table.column_names), sorted(duck_table.column_names)
    if a != b:
        return f"columns {a} and {b}"
    kinds = [(n, str(spark_table.schema.field(n).type), str(duck_table.schema.field(n).type)) for n in a]
    odd = [k for k in kinds if k[1].replace("large_", "") != k[2].replace("large_", "") and not (k[1] == "null" or k[2] == "null")]
    x, y = rows(spark_table), rows(duck_table)
    if len(x) != len(y):
        return f"{len(x)} and {len(y)} rows"
    bad = [(p, q) for p, q in zip(x, y) if p != q]
    if bad:
        return f"{len(bad)} of {len(x)} rows differ: {bad[:2]}"
    return f"types {odd}" if odd else ""
