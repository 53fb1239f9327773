"""Comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW \"{name}\" AS SELECT * FROM '{path}'")
    return con


def differences(df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    """What differs, or None; rows are compared as multisets of values and types."""
    relation = con.sql(sql)
    columns = sorted(df.columns)
    if sorted(relation.columns) != columns:
        return f"columns {columns} and {sorted(relation.columns)}"
    at = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(_plain(r[i]) for i in at) for r in relation.fetchall())
    found = Counter(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows for {sum(expected.values())}; not expected: "
        f"{list(extra.items())[:2]}; missing: {list(missing.items())[:2]}"
    )


def _plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return (type(value).__name__, value)
