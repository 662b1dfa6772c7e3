"""Compare a query's Spark rows with its oracle's DuckDB rows, order aside."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value != value:
        return None
    return str(value) if not isinstance(value, (int, float, str, bool)) else value


def rows(table) -> list[tuple]:
    """Rows of an Arrow table with columns by name, sorted."""
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns), key=repr)


def differences(spark_table, duck_table) -> list[str]:
    """Empty when both hold the same columns and rows."""
    if sorted(spark_table.column_names) != sorted(duck_table.column_names):
        return [f"columns {spark_table.column_names} != {duck_table.column_names}"]
    ours, theirs = rows(spark_table), rows(duck_table)
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    return [f"{a} != {b}" for a, b in zip(ours, theirs) if a != b][:5]
