"""Top-n per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group with their ``rank``, 1 first.

    Spark limits each group on the map side before the shuffle (``WindowGroupLimit``), so a group
    never sends more than ``n`` rows per task however large it is.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", position).filter(F.col("rank") <= n)
