"""CSV records that go over line breaks, read by many tasks at once.

A file is read as physical lines, whose order is known by their split (the offset where it begins) and by their place in it.
A line either begins inside a quoted cell or outside, and what it does to that state is known without knowing the state: it
keeps it, turns it, or sets it. Chained over the lines of a split this gives the split's own effect, chained over the splits of a
file it gives the state at the start of each split, and with that every line knows whether a record begins there. The
lines of a record are joined inside their split; only what is cut by the border of a split is put together afterwards.

A line whose quotes fit no grammar in the state where it begins (text behind a closing quote, blanks before an opening one,
a lone carriage return), a last quote that nothing closes, and line breaks of both kinds in a file whose first one is a line feed have
no defined end here; a source with any of these is left to Spark's own reader.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.operators.lineage import written

SPLIT = ("file", "block")
# After doubled quotes are taken out: the next whole cell, quoted or not, and what is left before a cell that goes on.
WHOLE_CELL = r'\G(?:"[^"]*"|(?!\s*")[^,]*)(?:,|$)'
OPEN_CELL = r'^"[^"]*$'


def without_return(line: Column) -> Column:
    """The line without the carriage return of its own line break."""
    return F.when(line.endswith("\r"), F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, at, line)``: lines with the split they are read in and their place among its lines."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def with_effect(lines: DataFrame) -> DataFrame:
    """Lines with what they do: the state after them when they begin ``outside`` or ``inside`` of quotes (true is inside),
    and whether they fit no grammar then (``odd_outside``, ``odd_inside``).

    One projection after the other, as each step is used more than once and would be computed as often otherwise.
    """
    quoted = F.col("line").contains('"')
    steps = lines.withColumn("plain", without_return(F.col("line")))
    steps = steps.withColumns({
        "lone": F.col("plain").contains("\r"),
        # Lines without quotes, most of them, change nothing.
        "marks": F.when(quoted, F.replace("plain", F.lit('""'), F.lit(""))).otherwise("")})
    steps = steps.withColumns({
        "closes": F.col("marks").contains('"'), "behind": F.substr("marks", F.instr("marks", '"') + 1),
        "rest": F.regexp_replace("marks", WHOLE_CELL, "")})
    steps = steps.withColumns({
        "opens": F.col("rest").rlike(OPEN_CELL), "rest_behind": F.regexp_replace("behind", WHOLE_CELL, ""),
        "text_behind": ~F.col("behind").startswith(",") & (F.col("behind") != "")})
    steps = steps.withColumn("opens_behind", F.col("rest_behind").rlike(OPEN_CELL))
    return steps.select(
        *lines.columns, F.col("opens").alias("outside"), (~F.col("closes") | F.col("opens_behind")).alias("inside"),
        (F.col("lone") | ((F.col("rest") != "") & ~F.col("opens"))).alias("odd_outside"),
        (F.col("lone") | (F.col("closes") & (F.col("text_behind") | ((F.col("rest_behind") != "") & ~F.col("opens_behind"))))).alias("odd_inside"))


def _chained(rows: DataFrame, within: tuple[str, ...], order: str, outside: Column, inside: Column) -> DataFrame:
    """Rows with ``sets`` and ``turns``: the last state that any row up to here sets (null: none does), turned by the rows
    since, and whether the state is turned an odd number of times."""
    so_far = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum((outside & ~inside).cast("long")).over(so_far)
    rows = rows.withColumn("turned", turned)
    last = F.last(F.when(outside == inside, F.struct(outside.alias("state"), F.col("turned").alias("turned"))), True).over(so_far)
    rows = rows.withColumn("last", last)
    return rows.withColumns({
        "sets": F.col("last.state") != ((F.col("turned") - F.col("last.turned")) % 2 == 1),
        "turns": F.col("turned") % 2 == 1}).drop("turned", "last")


def _state(before: Column) -> Column:
    """The state after a chained row that began with ``before``."""
    return F.when(F.col("sets").isNotNull(), F.col("sets")).otherwise(before != F.col("turns"))


def _split_starts(lines: DataFrame) -> tuple[DataFrame, bool]:
    """``(file, block, starts, returns)``: whether each split begins inside of quotes, and whether the file's line breaks have a
    carriage return, as its first one tells; and whether all files fit the grammar."""
    telling = lines.filter(F.col("line").contains('"') | without_return(F.col("line")).contains("\r"))
    quotes = written(with_effect(telling).drop("line"), "csv-quotes")
    chained = written(_chained(quotes, SPLIT, "at", F.col("outside"), F.col("inside")), "csv-quote-states")
    ends = chained.groupBy(*SPLIT).agg(F.max_by(F.struct("sets", "turns"), "at").alias("end")).select(*SPLIT, "end.*")
    returned = F.col("line").endswith("\r")
    splits = lines.groupBy(*SPLIT).agg(F.min_by(returned, "at").alias("returns"), F.bool_or(returned).alias("any_returns"))
    splits = splits.join(ends, list(SPLIT), "left")
    # A split as a whole has an effect like a line's.
    outside = F.coalesce("sets", "turns", F.lit(False))
    inside = F.coalesce("sets", ~F.col("turns"), F.lit(True))
    splits = splits.select(*SPLIT, "returns", "any_returns", outside.alias("outside"), inside.alias("inside"))
    splits = _chained(splits, ("file",), "block", F.col("outside"), F.col("inside"))
    in_order = Window.partitionBy("file").orderBy("block")
    after = _state(F.lit(False))
    starts = written(splits.select(
        *SPLIT, F.lag(after, 1, False).over(in_order).alias("starts"), F.first("returns").over(in_order).alias("returns"), "any_returns",
        (after & F.lead("block").over(in_order).isNull()).alias("unclosed")), "csv-split-starts")

    states = chained.join(starts, list(SPLIT))
    begins = F.lag(_state(F.col("starts"))).over(Window.partitionBy(*SPLIT).orderBy("at"))
    states = states.withColumn("begins", F.coalesce(begins, "starts"))
    odd = states.filter(F.when(F.col("begins"), F.col("odd_inside")).otherwise(F.col("odd_outside")))
    regular = starts.filter("unclosed OR (any_returns AND NOT returns)").isEmpty() and odd.isEmpty()
    return starts.select(*SPLIT, "starts", "returns"), regular


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(parts), lambda part: part["text"]), "\n")


def _parts(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """``(file, block, first, returns, text, open)``: what each split has of a record; ``first`` is null for the rest of one that an earlier
    split begins, ``open`` says that the record goes on in the next split."""
    known = F.col("starts")
    # Where a split begins depends on its size, which must not have changed since the states were taken.
    begins = F.when(known.isNull(), F.raise_error(F.lit("the splits of a CSV source have changed while it was read"))).otherwise(known)
    lines = with_effect(lines.join(starts, list(SPLIT), "left").withColumn("starts", begins))
    lines = _chained(lines, SPLIT, "at", F.col("outside"), F.col("inside")).withColumn("after", _state(F.col("starts")))
    in_order = Window.partitionBy(*SPLIT).orderBy("at")
    inside = F.coalesce(F.lag("after").over(in_order), "starts")
    lines = lines.withColumn("begins", F.when(~inside, F.col("at")))
    first = F.last("begins", True).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("first", first).groupBy(*SPLIT, "first").agg(
        F.first("returns").alias("returns"), _joined(F.collect_list(F.struct("at", F.col("line").alias("text")))).alias("text"), F.max_by("after", "at").alias("open"))


def _records(parts: DataFrame) -> DataFrame:
    """``(file, block, first, text)``: whole records and where they begin, line breaks as line feeds."""
    whole = F.col("first").isNotNull() & ~F.col("open")
    in_order = Window.partitionBy("file").orderBy("block", F.col("first").asc_nulls_first())
    # At most two parts of a split are cut by its borders.
    cut = parts.filter(~whole).withColumn("record", F.count("first").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("block", F.coalesce("first", F.lit(-1)).alias("first"))
    mended = cut.groupBy("file", "record").agg(
        F.first("returns").alias("returns"),
        F.min(F.when(F.col("first").isNotNull(), F.struct("block", "first"))).alias("place"),
        _joined(F.collect_list(F.struct(place.alias("place"), "text"))).alias("text"))
    found = parts.filter(whole).select(*SPLIT, "first", "returns", "text").unionByName(mended.select("file", "place.*", "returns", "text"))
    feeds = F.replace(without_return(F.col("text")), F.lit("\r\n"), F.lit("\n"))
    return found.select(*SPLIT, "first", F.when(F.col("returns"), feeds).otherwise(F.col("text")).alias("text"))


def _fields(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def split_rows(spark: SparkSession, path: str, header: list[str], names: list[str], check_header: bool,
               options: dict[str, str]) -> DataFrame | None:
    """All rows of a CSV source as strings, its files read in splits; None if its quotes fit no grammar.

    The first record of each file is its header. Blank lines are dropped, and line breaks inside quotes become line feeds if they
    are those of the records.
    """
    lines = physical_lines(spark, path)
    starts, regular = _split_starts(lines)
    if not regular:
        return None
    records = _records(written(_parts(lines, starts), "csv-record-parts")).filter("text != ''")
    heads = written(records.groupBy("file").agg(F.min(F.struct("block", "first", "text")).alias("head")).select("file", "head.*"), "csv-heads")
    if check_header:
        found = F.from_csv("text", _fields([f"c{k}" for k in range(len(header) + 1)]), options)
        cells = F.array(*[F.lower(found[f"c{k}"]) for k in range(len(header) + 1)])
        expected = F.array(*[F.lower(F.lit(h)) for h in header], F.lit(None))
        other = heads.filter(~cells.eqNullSafe(expected)).first()
        if other is not None:
            raise csv.Error(f"the header of {other['file']} is not that of the other files")
    rows = records.join(heads.select(*SPLIT, "first"), [*SPLIT, "first"], "left_anti")
    return rows.select(F.from_csv("text", _fields(names), options).alias("row")).select("row.*")
