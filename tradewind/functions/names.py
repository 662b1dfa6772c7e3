"""Header names: header-sized work, done on the driver."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame


def normalize_name(raw: str) -> str:
    """Accent-free lower-case words joined by ``_``; a leading digit gets the prefix ``col_``."""
    folded = unicodedata.normalize("NFKD", raw).encode("ascii", "ignore").decode("ascii")
    name = "_".join(re.findall(r"[0-9A-Za-z]+", folded)).lower()
    return f"col_{name}" if name[:1].isdigit() else name


def normalize_header(header: Iterable[str]) -> list[str]:
    """Normalise a header by position; a repeated name becomes ``name_1``, ``name_2``, …

    A header cell with nothing left after normalisation is named after its position.
    """
    taken: list[str] = []
    for position, raw in enumerate(header, start=1):
        base = name = normalize_name(raw) or f"col_{position}"
        repeat = 0
        while name in taken:
            repeat += 1
            name = f"{base}_{repeat}"
        taken.append(name)
    return taken


def normalize_columns(df: DataFrame) -> DataFrame:
    """The same rows under normalised column names."""
    return df.toDF(*normalize_header(df.columns))
