"""Mixing sources to target weights (operator 2).

Sizes are summed per source, each source gets a target, and target / size is its repetition rate. A
document is taken floor(rate) times plus once more with the probability of the fraction, drawn from a
hash of its id and text; reruns agree, and copies of a text under different ids are drawn independently.

A null text has no words. A null source is a source of its own, and the last one. Rows equal in id and
text get the same draw. A source without words has target 0 and is taken not at all. An empty table gives
an empty mix. Other columns are kept; those that clash with the ones added stay and the new ones are
given by struct ``mix`` under a longer name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.llm.common import column, fresh_name, text_or_empty, word_count
from tradewind.operators.lineage import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 by code point, null last; no task holds all of them.

    Ranges of sources are counted and each row adds the rows of the ranges before its own.
    """
    dealt = written(
        sources.repartitionByRange(F.col("source").isNull(), "source")
        .withColumn("range", F.spark_partition_id()), "sources")
    before = (
        dealt.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))  # a row per shuffle partition
        .withColumn("before", F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))))
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").isNull(), "source"))
    return (
        dealt.withColumn("place", place).join(before, "range")
        .select("source", "source_size", (F.coalesce("before", F.lit(0)) + F.col("place") - 1).alias("rank")))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size)``.

    The weights repeat along the sources and share ``share`` times all sizes. A source whose part is
    above ``most`` times its size stops there; what it leaves is shared again among the others by
    weight, until none is above. Each round is one aggregation of the sources.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sums = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    sources = written(
        _ranked(sums)
        .select("source", "source_size", F.get(cycle, (F.col("rank") % len(weights)).cast("int")).alias("weight"),
                (F.col("source_size") * F.lit(float(most))).alias("top")), "weights")
    everything = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # the level only rises, so a source that is full stays full
        stopped = F.col("top") < F.col("weight") * F.lit(level)
        found = sources.agg(
            F.count_if(stopped).alias("full"), F.sum(F.when(stopped, F.col("top"))).alias("used"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("weight")).first()
        if found["full"] == full or not found["weight"]:
            break
        full = found["full"]
        level = (min(share, most) * everything - (found["used"] or 0.0)) / found["weight"]
    return sources.select(
        "source", "source_size", F.least("top", F.col("weight") * F.lit(level)).alias("target"))


def _draw(id_: Column, text: Column) -> Column:
    """A number in [0, 1): the first 52 bits of a hash of id and text."""
    seed = F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(":"), F.md5(text.cast("binary")))
    return F.conv(F.substring(F.md5(seed.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def mix_plan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> tuple[DataFrame, str]:
    """Every row of ``docs`` with a struct of ``size``, ``source_size``, ``target`` and ``copies``, and the
    struct's name.

    The sources are small beside the documents, but not assumed so: their table is written, so Spark
    knows its size, broadcasts it when it is small and otherwise joins by sorting, where a hot source
    is split.
    """
    name, body = fresh_name(docs, "mix"), text_or_empty(column(text))
    sizes = docs.select(column(source).cast("string").alias("source"), word_count(body).alias("size"))
    targets = written(source_targets(sizes, weights, share, most), "targets").select(
        F.struct("source", "source_size", "target").alias(name))
    of = column(name)
    joined = docs.join(targets, column(source).cast("string").eqNullSafe(of["source"]))
    rate = F.when(of["source_size"] > 0, of["target"] / of["source_size"]).otherwise(F.lit(0.0))
    draw = _draw(column(id_column), body)
    return joined.withColumn(name, F.struct(
        word_count(body).alias("size"), of["source_size"].alias("source_size"), of["target"].alias("target"),
        (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long").alias("copies"))), name


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is taken."""
    planned, name = mix_plan(docs, **options)
    copies = column(name)["copies"]
    return (
        planned.filter(copies > 0)
        .withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), copies)))
        .drop(column(name)))
