"""Showing the next content of a table and of its rejects as one change.

New files are written beside the current ones, below ``_loads`` in the database's folder. Two small manifests there make a load one
change of both tables, whatever fails and when:

1. ``<table>.writing.json`` names the new folders before anything is written to them.
2. ``<table>.committed.json`` tells where each table was and where it shall be. It appears by a rename; from here on the load counts.
3. The catalog is changed table by table.
4. Old folders go, then the manifests, the second one last.

A load that ended before step 2 is undone by ``recover``, one that ended later is carried through, so both tables are old or
both are new. Every load recovers its own table first, and a load of a folder all tables of the database. An error
in step 3 that the process survives is undone at once. Each step may be repeated. One process loads a table at a time, and renames
have to be atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources.csv_files import hadoop_path, write_text
from tradewind.sources.infer import create_table_sql, qualified

FOLDER = "_loads"
WRITING, COMMITTED = ".writing.json", ".committed.json"
# What a failed query or job raises.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class Content:
    """Where a table's files are; ``schema`` (JSON) and ``mark`` (a property) for tables that are made by a load."""

    location: str
    schema: str = ""
    mark: str = ""


@dataclass(frozen=True)
class Change:
    """A table before and after a load. ``made`` tables are created and dropped, None being no table; others only move."""

    table: str
    before: Content | None
    after: Content | None
    made: bool = False


def details(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()  # a row per column and property
    return {row["col_name"]: row["data_type"] for row in rows}


def has_mark(spark: SparkSession, table: str, mark: str) -> bool:
    return not spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == mark).isEmpty()


def _run(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def _delete(spark: SparkSession, path: str) -> None:
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)


def _put(spark: SparkSession, path: str, content: Any) -> None:
    """Write JSON so that the whole file appears at once."""
    draft = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, json.dumps(content), draft)
    (source, fs), (target, _) = hadoop_path(spark, draft), hadoop_path(spark, path)
    fs.delete(target, False)
    if not fs.rename(source, target):
        raise OSError(f"cannot write {path}")


def _get(spark: SparkSession, path: str) -> Any:
    """JSON of a file; None if there is none."""
    target, fs = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    return json.loads("\n".join(row["value"] for row in spark.read.text(path, wholetext=True).collect()))


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_at(spark: SparkSession, table: str, location: str) -> bool:
    here, there = (hadoop_path(spark, path) for path in (details(spark, table)["Location"], location))
    return here[1].makeQualified(here[0]).equals(there[1].makeQualified(there[0]))


def _move(spark: SparkSession, table: str, location: str) -> None:
    if not _is_at(spark, table, location):
        _run(spark, f"ALTER TABLE {table} SET LOCATION {_quoted(location)}")
        spark.catalog.refreshTable(table)


def _drop(spark: SparkSession, table: str, mark: str, nowhere: str) -> None:
    """Drop a table that a load has made, but not its files."""
    if spark.catalog.tableExists(table) and has_mark(spark, table, mark):
        if details(spark, table).get("Type") == "MANAGED":
            _move(spark, table, nowhere)
        _run(spark, f"DROP TABLE {table}")


def _show(spark: SparkSession, change: Change, content: Content | None, nowhere: str) -> None:
    """Make the catalog show this content, unless it does already."""
    if not change.made:
        _move(spark, change.table, content.location)
        return
    exists = spark.catalog.tableExists(change.table)
    if exists and content is not None and _is_at(spark, change.table, content.location):
        return
    for known in (change.before, change.after):
        if known is not None:
            _drop(spark, change.table, known.mark, nowhere)
    if content is not None:
        schema = T.StructType.fromJson(json.loads(content.schema))
        _run(spark, f"{create_table_sql(change.table, schema)} TBLPROPERTIES ('{content.mark}' = 'true') LOCATION {_quoted(content.location)}")


class Publication:
    """The next content of a table and of those that change with it."""

    def __init__(self, spark: SparkSession, database: str, table: str):
        root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
        self.spark, self.database, self.table = spark, database, table
        self.folder, self.first = f"{root}/{FOLDER}", f"{root}/{table.lower()}"
        self.new: list[str] = []
        self.changes: list[Change] = []

    def _manifest(self, kind: str) -> str:
        return f"{self.folder}/{self.table}{kind}"

    @property
    def _nowhere(self) -> str:
        return f"{self.folder}/nowhere"

    def begin(self, *labels: str) -> list[str]:
        """Fresh folders for new files."""
        self.new = [f"{self.folder}/{label}-{uuid.uuid4().hex}" for label in labels]
        _put(self.spark, self._manifest(WRITING), {"new": self.new})
        return self.new

    def commit(self, changes: list[Change]) -> None:
        """From here on the new content counts, whether it is shown yet or not."""
        self.changes = changes
        _put(self.spark, self._manifest(COMMITTED), {"new": self.new, "changes": [asdict(c) for c in changes]})

    def show(self) -> None:
        for change in self.changes:
            _show(self.spark, change, change.after, self._nowhere)

    def _owned(self, location: str) -> bool:
        """Whether files are a load's own, or those of a table as it was created."""
        return f"/{FOLDER}/" in location or location.rstrip("/") == self.first

    def finish(self) -> None:
        """Remove what the new content replaces, and the manifests."""
        after = {c.after.location for c in self.changes if c.after}
        for change in self.changes:
            if change.before and change.before.location not in after and self._owned(change.before.location):
                _delete(self.spark, change.before.location)
        for path in self.new:
            if path not in after:
                _delete(self.spark, path)
        _delete(self.spark, self._nowhere)
        _delete(self.spark, self._manifest(WRITING))
        _delete(self.spark, self._manifest(COMMITTED))

    def undo(self) -> None:
        """Show the old content again, and remove the new files and the manifests."""
        for change in self.changes:
            _show(self.spark, change, change.before, self._nowhere)
        _delete(self.spark, self._manifest(COMMITTED))
        for path in [*self.new, self._nowhere]:
            _delete(self.spark, path)
        _delete(self.spark, self._manifest(WRITING))

    def publish(self, changes: list[Change]) -> None:
        """All steps after the writing. An error leaves the old content; what only fails to be cleaned up is left to
        ``recover``."""
        self.commit(changes)
        try:
            self.show()
        except SPARK_ERRORS:
            self.undo()
            raise
        try:
            self.finish()
        except SPARK_ERRORS:
            return

    def recover(self) -> str:
        """End a load that was broken off: ``finished``, ``undone`` or, if there is none, an empty text."""
        committed = _get(self.spark, self._manifest(COMMITTED))
        writing = _get(self.spark, self._manifest(WRITING))
        if committed is None and writing is None:
            return ""
        self.new = (committed or writing)["new"]
        if committed is None:
            self.undo()
            return "undone"
        for change in committed["changes"]:
            contents = {side: change[side] and Content(**change[side]) for side in ("before", "after")}
            self.changes.append(Change(change["table"], made=change["made"], **contents))
        self.show()
        self.finish()
        return "finished"


def recover(spark: SparkSession, database: str, table: str) -> str:
    return Publication(spark, database, table).recover()


def recover_database(spark: SparkSession, database: str) -> DataFrame:
    """End all loads of a database that were broken off: ``(table_name, outcome)``. No load may be running."""
    folder = Publication(spark, database, "").folder
    target, fs = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    tables = sorted({n.removesuffix(kind) for n in names for kind in (WRITING, COMMITTED) if n.endswith(kind)})
    return spark.createDataFrame([(t, recover(spark, database, t)) for t in tables], "table_name string, outcome string")


def sweep(spark: SparkSession, database: str) -> list[str]:
    """Delete folders of loads that neither a table of the database nor a manifest names; returns them."""
    folder = Publication(spark, database, "").folder
    target, fs = hadoop_path(spark, folder)
    if not fs.exists(target):
        return []
    listed = [s.getPath() for s in fs.listStatus(target)]
    named = {path.rsplit("/", 1)[-1] for p in listed if p.getName().endswith((WRITING, COMMITTED))
             for path in (_get(spark, p.toString()) or {"new": []})["new"]}
    for table in spark.catalog.listTables(database):
        if not table.isTemporary and table.tableType != "VIEW":
            named.add(details(spark, qualified(database, table.name)).get("Location", "").rstrip("/").rsplit("/", 1)[-1])
    stray = [p for p in listed if fs.getFileStatus(p).isDirectory() and p.getName() not in named]
    for path in stray:
        fs.delete(path, True)
    return sorted(p.getName() for p in stray)
