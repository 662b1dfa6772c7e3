"""Cutting lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradewind.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For an expensive relation that a job reads several times: it is computed once, survives lost
    executors, and its size is known to the planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
