"""Joins with a side whose size is only known at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Narrow rows (a key and a value or two) that fit every executor many times over.
SMALL_ROWS = 500_000


def join_counted(big: DataFrame, narrow: DataFrame, on: str, how: str = "inner",
                 rows: int | None = None) -> DataFrame:
    """Join ``big`` with a narrow relation, broadcast only when it has at most ``SMALL_ROWS`` rows.

    Without statistics Spark must plan a shuffle of ``big`` before it learns that the other side is
    tiny. Counting that side first saves the shuffle; a large side gets the plain join, which AQE
    splits where keys are hot. Pass ``rows`` when the count is already known.
    """
    if rows is None:
        rows = narrow.count()
    return big.join(F.broadcast(narrow) if rows <= SMALL_ROWS else narrow, on, how)
