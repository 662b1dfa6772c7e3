"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.lineage import written


def _contract(edges: DataFrame, round_: int) -> tuple[DataFrame, DataFrame]:
    """One round: each node's parent (itself or a neighbour, the one of lowest random rank), and the
    edges between different parents."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = lambda c: F.struct(F.xxhash64(F.lit(round_), c), c.alias("node"))
    parents = written(
        both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("best"))
        .select(F.col("a").alias("node"), F.least("best", rank(F.col("a")))["node"].alias("parent")), "parents")
    # Both sides of each join are read from files, so a hub's partition can be split.
    left = edges.join(parents, edges["a"] == parents["node"]).select(F.col("parent").alias("pa"), "b")
    moved = left.join(parents, left["b"] == parents["node"]).select("pa", F.col("parent").alias("pb"))
    left_over = moved.filter("pa != pb").select(
        F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
    return parents, written(left_over, "edges")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; the component is its smallest node.

    Each round every node joins its neighbour of lowest random rank, and the edges inside the groups go.
    A random rank shrinks paths as well as stars by a constant part, so the rounds are about the
    logarithm of the nodes, whatever the shape and the order of ids. Edges with a null end and loops
    are left out, repeated edges count once; no edges give no rows. Nothing is gathered in one place.
    """
    rest = written(
        edges.select("a", "b").filter("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds = []
    while not rest.isEmpty():
        parents, rest = _contract(rest, len(rounds))
        rounds.append(parents)
    if not rounds:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def follow(found: DataFrame, parents: DataFrame) -> DataFrame:
        step = parents.select(F.col("node").alias("root"), "parent")
        return found.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))

    roots = written(reduce(follow, rounds[1:], rounds[0].select("node", F.col("parent").alias("root"))), "roots")
    smallest = written(roots.groupBy("root").agg(F.min("node").alias("component")), "smallest")
    return roots.join(smallest, "root").select("node", "component")
