"""Working on groups of rows inside ``mapInPandas``, where groups are small and many."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def dealt(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Rows of a key together and in one task. ``tasks`` is given when the work is not in proportion to
    the bytes, by which partitions are merged otherwise."""
    parts = df.repartition(key) if tasks is None else df.repartition(tasks, key)
    return parts.sortWithinPartitions(key)


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The rows in frames that no group of equal keys is cut by; rows of a group must follow each other."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[keys].iloc[-1]
        differs = np.flatnonzero((batch[keys] != last).any(axis=1).to_numpy())
        border = differs[-1] + 1 if len(differs) else 0
        if border or (held and (held[-1][keys].iloc[-1] != last).any()):
            whole = pd.concat([*held, batch.iloc[:border]], ignore_index=True)
            held = []
            if len(whole):
                yield whole
        held.append(batch.iloc[border:])
    if held:
        yield pd.concat(held, ignore_index=True)


def group_starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end."""
    if not len(values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))
