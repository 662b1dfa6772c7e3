"""CSV files as DataFrames of strings.

A CSV source is a single file or a folder of part files, as Spark writes them; both end in
``.csv``. Rows are read by the executors; the driver only sees names and headers.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.names import normalize_header, normalize_name
from tradewind.sources.records import split_rows

# CSV sources worked on at the same time, so that small ones do not leave the cluster idle.
SOURCES_AT_ONCE = 4
# Physical lines first looked at for the header, which may contain quoted line breaks.
HEADER_LINES = 10
# A header that goes on for longer has a quote that is never closed.
MOST_HEADER_LINES = 1_000


@dataclass(frozen=True)
class CsvScan:
    """A scanned CSV: its header as written, its normalised names, all rows as strings, and whether
    quoted line breaks keep its files from being split."""

    header: list[str]
    names: list[str]
    rows: DataFrame
    multiline: bool = False


def hadoop_path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The path and the file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all CSV sources in a folder, sorted by name; the suffix may be upper case."""
    target, fs = hadoop_path(spark, folder)
    if not fs.exists(target) or not fs.getFileStatus(target).isDirectory():
        raise FileNotFoundError(folder)
    paths = [status.getPath() for status in fs.listStatus(target)]
    return [p.toString() for p in sorted(paths, key=lambda p: p.getName())
            if p.getName().lower().endswith(".csv")]


def _literal(path: str) -> str:
    """The path with the characters escaped that Spark would read as a glob pattern."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def for_each_source(work: Callable[[Any], Any], sources: list) -> list:
    """Results of ``work`` on every source, in order; a few run at the same time."""
    with ThreadPoolExecutor(SOURCES_AT_ONCE) as pool:
        return list(pool.map(work, sources))


def table_name(path: str) -> str:
    """Table name of a CSV source: its file name without suffix, normalised."""
    return normalize_name(path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0])


def read_header(spark: SparkSession, path: str) -> list[str] | None:
    """The header cells as written; None for an empty file."""
    wanted = HEADER_LINES
    while True:
        lines = [row.value for row in spark.read.text(_literal(path)).take(wanted)]
        reader = csv.reader(line + "\n" for line in lines)
        header = next(reader, None)
        if reader.line_num < len(lines) or len(lines) < wanted:
            return header
        if wanted >= MOST_HEADER_LINES:
            raise csv.Error(f"the header of {path} does not end within {wanted} lines")
        wanted *= 10  # the header may go on


def open_quote(line: Column) -> Column:
    """False when a physical line is a complete record by itself.

    Only a field that starts with a quote and does not end with one can go on in the next line; a
    quote inside an unquoted field is text. Unusual quoting of a field that starts with a quote is
    reported as open too.
    """
    undoubled = F.replace(line, F.lit('""'), F.lit(""))
    return F.regexp_replace(undoubled, r'(^|,)"[^"]*"(?=,|$)', "$1").rlike(r'(^|,)\s*"')


def has_quoted_line_breaks(spark: SparkSession, path: str) -> bool:
    """False when every physical line is a complete record, so the file can be split safely.

    True may be a false alarm, which costs parallelism but no rows.
    """
    line = F.col("value")
    return not spark.read.text(_literal(path)).filter(line.contains('"')).filter(open_quote(line)).isEmpty()


def has_large_files(spark: SparkSession, path: str) -> bool:
    """Whether any file of a source is larger than what one task should read."""
    target, fs = hadoop_path(spark, path)
    status = fs.getFileStatus(target)
    files = fs.listStatus(target) if status.isDirectory() else [status]
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return any(f.getLen() > most for f in files if not f.getPath().getName().startswith(("_", ".")))


def scan_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> CsvScan | None:
    """Scan one CSV source; None when it is empty.

    Quotes are escaped by doubling, short rows are padded with NULL, extra cells are ignored, empty
    cells are NULL, undecodable bytes become U+FFFD, and blank lines are dropped. Spark's reader takes a
    file with quoted line breaks in one task, so ``multiline=None`` looks for them first and splits the files when there
    are none. Files with them that are larger than ``spark.sql.files.maxPartitionBytes`` are read in splits too, and their
    records put together (see ``records``), unless quotes are used in a way that leaves the end of a record open.
    """
    header = read_header(spark, path)
    if not header:
        return None
    if multiline is None:
        multiline = has_quoted_line_breaks(spark, path)
    names = normalize_header(header)
    target, fs = hadoop_path(spark, path)
    folder = fs.getFileStatus(target).isDirectory()
    # Part files must agree on the header; Spark checks that by name when names are unambiguous.
    checked = folder and all(header) and len({h.lower() for h in header}) == len(header)
    fields = header if checked else names
    columns = max(20480, len(header) * 2)
    if multiline and has_large_files(spark, path):
        options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxColumns": str(columns)}
        rows = split_rows(spark, _literal(path), header, names, checked, options)
        if rows is not None:
            return CsvScan(header, names, rows)
    rows = spark.read.csv(
        _literal(path), schema=T.StructType([T.StructField(f, T.StringType()) for f in fields]),
        header=True, multiLine=multiline, quote='"', escape='"', encoding="UTF-8",
        mode="PERMISSIVE", enforceSchema=not checked, maxColumns=columns,
    ).toDF(*names)
    return CsvScan(header, names, rows, multiline)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Write a small text file, such as a DDL script, to any Hadoop file system."""
    target, fs = hadoop_path(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
