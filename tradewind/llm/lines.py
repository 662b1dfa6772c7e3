"""Line dedup by overlapping three-line windows (operator 4).

Every three consecutive lines that hold a word are a window. Windows that occur more than once anywhere
are found by one aggregation over their hashes; the first occurrence, by document id and line, stays, and
the lines that later ones cover (blank lines between them included) are cut from their documents. What overlaps the first
occurrence in its own document is not a later one, so four equal lines stay, and of seven the first three.

Lines are compared exactly, windows by 128 bits of hash. Rows with equal id and text count as one document
and are treated alike. Null ids come first. Null texts stay null, empty texts and texts of fewer than
three lines with words stay as they are, and a document may lose all its lines and become empty. Other
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import BLANKS, column, fresh_name, let
from tradewind.operators.lineage import written

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(text: Column, window: int) -> Column:
    """First and last line and two hashes of each window."""
    def hashed(line: Column, at: Column) -> Column:
        return F.struct(at.alias("at"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
                        (F.length(F.translate(line, BLANKS, "")) > 0).alias("counts"))

    def windows(lines: Column) -> Column:
        def one(at: Column) -> Column:
            part = [F.get(lines, at + k) for k in range(window)]
            return F.struct(part[0]["at"].alias("first"), part[-1]["at"].alias("last"),
                            F.xxhash64(*[p["a"] for p in part]).alias("a"),
                            F.xxhash64(*[p["b"] for p in part]).alias("b"))
        return F.when(F.size(lines) >= window,
                      F.transform(F.sequence(F.lit(0), F.size(lines) - window), one))

    return let(F.filter(F.transform(_lines(text), hashed), lambda line: line["counts"]), windows)


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """``(id, version, spans)``: the line ranges that later occurrences cover, per document that has any.
    ``version`` is the hash of the text."""
    rows = written(
        docs.select(column(id_column).alias("id"), F.xxhash64(column(text)).alias("version"),
                    F.explode(_windows(column(text).cast("string"), window)).alias("w"))
        .select("id", "version", "w.first", "w.last", "w.a", "w.b"), "windows")
    place = F.struct("id", "version", "first", "last")
    owners = written(
        rows.groupBy("a", "b").agg(F.min(place).alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n"), "owners")
    # Both sides are read from files, so a hot window's partition can be split.
    of = F.col("owner")
    overlaps = F.col("id").eqNullSafe(of["id"]) & F.col("version").eqNullSafe(of["version"]) & (F.col("first") <= of["last"])
    later = rows.join(owners, ["a", "b"]).filter(~overlaps)
    return later.groupBy("id", "version").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _without(lines: Column, spans: Column) -> Column:
    covered = F.flatten(F.transform(spans, lambda s: F.sequence(s["first"], s["last"])))
    kept = F.sort_array(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered))
    return F.array_join(F.transform(kept, lambda at: F.get(lines, at)), "\n")


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW,
                removed: str | None = None) -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut from ``text``. ``removed`` names a column
    for the number of lines cut, if wanted."""
    name = fresh_name(docs, "cut")
    spans = repeated_spans(docs, id_column, text, window).select(F.struct("id", "version", "spans").alias(name))
    of, body = column(name), column(text).cast("string")
    same = column(id_column).eqNullSafe(of["id"]) & (F.xxhash64(column(text)) == of["version"])
    cut = F.when(of.isNull(), body).otherwise(let(_lines(body), lambda lines: _without(lines, of["spans"])))
    out = docs.join(spans, same, "left")
    if removed is not None:
        left = F.when(of.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(
            F.flatten(F.transform(of["spans"], lambda s: F.sequence(s["first"], s["last"]))))))
        out = out.withColumn(removed, left.cast("long"))
    return out.withColumn(text, cut).drop(column(name))
