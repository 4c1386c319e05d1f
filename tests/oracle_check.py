"""Compare a query's rows with those of its SQL, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences as text; empty when equal."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    want = rows_of(names, found.fetchall())
    have = rows_of(df.columns, df.collect())
    if want == have:
        return []
    return [
        f"rows {sum(have.values())} vs {sum(want.values())} in SQL",
        *[f"only in Spark: {row}" for row in list((have - want))[:3]],
        *[f"only in SQL:   {row}" for row in list((want - have))[:3]],
    ]
