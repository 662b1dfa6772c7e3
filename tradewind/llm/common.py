"""What several operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but blank, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers that share this machine's files import the package, wherever Python was started.
    On other machines it has to be installed, or shipped with ``addPyFile``."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    root = str(Path(__file__).resolve().parents[2])
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda sum_, x: sum_ + x)


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (upper and lower case count as equal)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
