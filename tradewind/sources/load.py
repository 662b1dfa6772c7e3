"""Full-refresh load of CSV sources into typed tables, with an audit trail."""

from __future__ import annotations

import csv
import time
from collections.abc import Callable
from dataclasses import astuple, dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.cells import stripped, typed
from tradewind.sources.csv_files import CsvScan, for_each_source, list_csv, scan_csv, table_name
from tradewind.sources.infer import create_tables, infer_schema, qualified
from tradewind.sources.publish import SPARK_ERRORS, Change, Content, Publication, details, has_mark, recover, recover_database

REJECTS_SUFFIX = "_rejects"
# Property of the tables of rejects; a table without it is never touched as one.
REJECTS_MARK = "tradewind.rejects"
BAD = "bad_columns"
# Prefix of the typed columns beside the raw ones; no normalised name contains a space.
TYPED = "typed "

# What a failed query or job raises, and what an unreadable header does.
SOURCE_ERRORS = (*SPARK_ERRORS, csv.Error)

AUDIT_SCHEMA = (
    "table_name string, status string, rows_loaded bigint, rows_rejected bigint,"
    " unmatched array<string>, seconds double, detail string")


@dataclass
class Audit:
    """What happened to one CSV source.

    ``status`` is loaded, rejected (bad values, table unchanged), failed (error, table unchanged),
    skipped_no_table, skipped_empty or skipped_no_columns; committed is one that is not shown yet. ``detail`` has the reason of a failure, or
    says that quoted line breaks kept the source's files from being split.
    """

    table_name: str
    status: str
    rows_loaded: int = 0
    rows_rejected: int = 0
    unmatched: list[str] = field(default_factory=list)
    seconds: float = 0.0
    detail: str = ""


def check(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of strings followed by their typed values (``TYPED`` prefix) and ``bad_columns``.

    ``bad_columns`` names the columns whose non-blank cell has no value of the declared type.
    Declared columns the source lacks are NULL.
    """
    cells = {f.name: F.col(f"`{f.name}`") for f in schema if f.name in rows.columns}
    values = [
        (typed(cells[f.name], f.dataType) if f.name in cells else F.lit(None).cast(f.dataType))
        .alias(TYPED + f.name) for f in schema]
    parsed = {f.name: cells[f.name] for f in schema
              if f.name in cells and not isinstance(f.dataType, T.StringType)}
    if not parsed:
        return rows.select("*", *values).withColumn(BAD, F.array().cast("array<string>"))
    # Nearly always empty, so whether a suspect cell is only blank is decided on the few that are
    # in it. One short expression per column keeps the generated code small enough to be compiled.
    suspects = F.array_compact(F.array(*[
        F.when(cell.isNotNull() & F.col(f"`{TYPED}{name}`").isNull(),
               F.struct(F.lit(name).alias("name"), cell.alias("cell")))
        for name, cell in parsed.items()]))
    bad = F.filter(suspects, lambda s: stripped(s["cell"]).isNotNull())
    return rows.select("*", *values).withColumn(BAD, F.transform(bad, lambda s: s["name"]))


def _typed_columns(schema: T.StructType) -> list[Column]:
    return [F.col(f"`{TYPED}{name}`").alias(name) for name in schema.names]


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of strings as ``schema``, matched by name; unconvertible cells are NULL."""
    return check(rows, schema).select(*_typed_columns(schema))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType,
                   multiline: bool | None = None) -> DataFrame:
    """A CSV source as typed rows; unconvertible cells are NULL."""
    scan = scan_csv(spark, path, multiline)
    return spark.createDataFrame([], schema) if scan is None else conform(scan.rows, schema)


def _holds_rejects(spark: SparkSession, table: str) -> bool:
    return has_mark(spark, table, REJECTS_MARK)


def _obstacle(spark: SparkSession, table: str) -> str:
    """Why a table cannot be refreshed; empty if it can."""
    if _holds_rejects(spark, table):
        return f"{table} holds the rejects of another source"
    found = details(spark, table)
    if found.get("Provider", "").lower() != "parquet" or "# Partition Information" in found:
        return f"{table} is not an unpartitioned Parquet table"
    return ""


def _rejects_change(spark: SparkSession, table: str, path: str, kept: DataFrame | None) -> Change:
    """The table of rejects before and after a load; its columns are those of the source, so it is made anew."""
    before = None
    if spark.catalog.tableExists(table) and _holds_rejects(spark, table):
        before = Content(details(spark, table)["Location"], spark.table(table).schema.json(), REJECTS_MARK)
    after = None if kept is None else Content(path, kept.schema.json(), REJECTS_MARK)
    return Change(table, before, after, made=True)


@dataclass(frozen=True)
class Layout:
    """How a table's files are ordered, so that filters skip most of them.

    Files hold ranges of the ``sort_by`` columns and are sorted by them, so the smallest and largest values in their footers
    tell whether a filter on the first of these columns, by range or by value, can match. ``find_by`` columns get Bloom
    filters, for looking up single values.
    """

    sort_by: tuple[str, ...] = ()
    find_by: tuple[str, ...] = ()


def _write_laid_out(rows: DataFrame, layout: Layout, path: str) -> None:
    if layout.sort_by:
        columns = [F.col(f"`{name}`") for name in layout.sort_by]
        rows = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
    blooms = {f"parquet.bloom.filter.enabled#{name}": "true" for name in layout.find_by}
    rows.write.options(**blooms).parquet(path)


def load_csv(spark: SparkSession, path: str, database: str, on_error: str = "reject",
             multiline: bool | None = None, scan: CsvScan | None = None, publish: bool = True,
             layout: Layout | None = None) -> Audit:
    """Replace a table's rows by a CSV source, matching columns by normalised name.

    ``on_error="reject"`` refuses the whole source when any value does not fit its column;
    ``"quarantine"`` loads the good rows and keeps the bad ones, as text with the names of the bad
    columns, in ``<table>_rejects``, a table of that name that the loader did not make being an error. The
    source is parsed once: rows and bad rows are counted while
    the typed rows are written. Only a source with bad rows is read again to keep them. Table and rejects change
    together (see ``publish``); a load of the table that was broken off is ended first. Pass ``scan`` when the source was
    scanned before, and ``publish=False`` to commit the load but leave the showing to ``publish.recover``. With a
    ``layout`` the rows are written a second time, in its order.
    """
    if on_error not in ("reject", "quarantine"):
        raise ValueError(f"unknown on_error {on_error!r}")
    table = table_name(path)
    target = qualified(database, table)
    if not spark.catalog.tableExists(target):
        return Audit(table, "skipped_no_table")
    if obstacle := _obstacle(spark, target):
        return Audit(table, "failed", detail=obstacle)
    recover(spark, database, table)
    scan = scan or scan_csv(spark, path, multiline)
    if scan is None:
        return Audit(table, "skipped_empty")
    schema = spark.table(target).schema
    if layout is not None and (other := [c for c in (*layout.sort_by, *layout.find_by) if c not in schema.names]):
        return Audit(table, "failed", detail=f"{target} has no column {', '.join(other)} to be laid out by")
    unmatched = [raw for raw, name in zip(scan.header, scan.names) if name not in schema.names]
    if len(unmatched) == len(scan.header):
        return Audit(table, "skipped_no_columns", unmatched=unmatched)

    checked = check(scan.rows, schema)
    is_bad = F.size(BAD) > 0
    counts = Observation()
    counted = checked.observe(
        counts, F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("bad"))
    kept, rejects = checked.filter(is_bad).select(*scan.names, BAD), qualified(database, table + REJECTS_SUFFIX)
    detail = "quoted line breaks: each file is read by one task" if scan.multiline else ""
    publication = Publication(spark, database, table)
    try:
        path, rejects_path, unsorted = publication.begin(table, table + REJECTS_SUFFIX, f"{table}-unsorted")
        # A range partitioning reads its rows twice, to sample them first, so rows are parsed and counted before.
        counted.filter(~is_bad).select(*_typed_columns(schema)).write.parquet(path if layout is None else unsorted)
        rejected = counts.get["bad"]
        if rejected and on_error == "reject":
            publication.undo()
            return Audit(table, "rejected", 0, rejected, unmatched, detail=detail)
        if rejected:
            if spark.catalog.tableExists(rejects) and not _holds_rejects(spark, rejects):
                publication.undo()
                return Audit(table, "failed", detail=f"{rejects} is a table of its own")
            kept.write.parquet(rejects_path)
        if layout is not None:
            _write_laid_out(spark.read.schema(schema).parquet(unsorted), layout, path)
        before = Content(details(spark, target)["Location"])
        changes = [Change(target, before, Content(path)), _rejects_change(spark, rejects, rejects_path, kept if rejected else None)]
    except SPARK_ERRORS:
        publication.undo()
        raise
    if not publish:
        publication.commit(changes)
        return Audit(table, "committed", counts.get["good"], rejected, unmatched, detail=detail)
    publication.publish(changes)
    return Audit(table, "loaded", counts.get["good"], rejected, unmatched, detail=detail)


def _load_each(spark: SparkSession, folder: str, database: str, load: Callable[[str], Audit]) -> DataFrame:
    def audited(path: str) -> tuple:
        started = time.monotonic()
        try:
            audit = load(path)
        except SOURCE_ERRORS as error:
            audit = Audit(table_name(path), "failed", detail=str(error))
        audit.seconds = time.monotonic() - started
        return astuple(audit)

    recover_database(spark, database)
    # Sources of the same table, and of a table and its rejects, stay in order; others run side by side.
    by_table: dict[str, list[str]] = {}
    for path in list_csv(spark, folder):
        by_table.setdefault(table_name(path).removesuffix(REJECTS_SUFFIX), []).append(path)
    audits = for_each_source(lambda paths: [audited(path) for path in paths], list(by_table.values()))
    return spark.createDataFrame(list(chain.from_iterable(audits)), AUDIT_SCHEMA)


def load_directory(spark: SparkSession, folder: str, database: str, on_error: str = "reject",
                   multiline: bool | None = None, layouts: dict[str, Layout] | None = None) -> DataFrame:
    """Load every CSV source of a folder; one audit row per source. An error fails only its source. ``layouts`` are by table
    name."""
    return _load_each(spark, folder, database, lambda path: load_csv(
        spark, path, database, on_error, multiline, layout=(layouts or {}).get(table_name(path))))


def ingest_directory(spark: SparkSession, folder: str, database: str, on_error: str = "reject",
                     multiline: bool | None = None, lattice: str = "rank") -> DataFrame:
    """Infer, create and load: like ``load_directory``, but tables that do not exist are created.

    A source is scanned for quoted line breaks once for both inference and load.
    """

    def ingest(path: str) -> Audit:
        scan = scan_csv(spark, path, multiline)
        table = table_name(path)
        if scan is None:
            return Audit(table, "skipped_empty")
        if not spark.catalog.tableExists(qualified(database, table)):
            create_tables(spark, database, {table: infer_schema(scan.rows, scan.names, lattice)})
        return load_csv(spark, path, database, on_error, scan=scan)

    return _load_each(spark, folder, database, ingest)


def audit_totals(audit: DataFrame) -> DataFrame:
    """Sources, rows and seconds per status."""
    return audit.groupBy("status").agg(
        F.count(F.lit(1)).alias("sources"), F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_rejected").alias("rows_rejected"), F.sum("seconds").alias("seconds"))
