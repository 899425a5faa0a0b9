"""Run registered queries beside their SQL on the same tables and compare all values."""

from __future__ import annotations

import math
import time

import duckdb
from pyspark.sql import SparkSession

from presslake.catalog.registry import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark: SparkSession, sf_dir: str, name: str, con=None) -> dict:
    """Row count and the first differing rows of one query (none for a match)."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    seconds = time.time() - start
    out = {"name": name, "rows": len(got), "seconds": round(seconds, 2), "checked": name in SQL, "diff": []}
    if name in SQL:
        con = con or connect(sf_dir)
        cursor = con.execute(SQL[name])
        columns = [d[0] for d in cursor.description]
        want = _rows(columns, cursor.fetchall())
        if sorted(columns) != sorted(df.columns):
            out["diff"] = [("columns", sorted(df.columns), sorted(columns))]
        elif got != want:
            missing = [r for r in want if r not in set(got)][:3]
            extra = [r for r in got if r not in set(want)][:3]
            out["diff"] = [("rows", len(got), len(want)), ("spark only", extra), ("sql only", missing)]
    return out
