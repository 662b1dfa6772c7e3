"""Counting shared customers of product pairs, in sparse form.

The input is a distinct ``(customer_id, product_id)`` relation, read several times. The dense customer x product and
product x product matrices are never built.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.lineage import written

# Products per slice of a customer's basket; a larger basket is cut into several slices.
CELL = 512
# Pairs of products one task should form.
PAIRS_PER_TASK = 1_000_000
# Customers of a product whose neighbours are packed; a product of more is counted pair by pair, combined before
# the shuffle.
PACKED_BUYERS = 100_000


def product_buyers(pairs: DataFrame) -> DataFrame:
    """Customers per product: the squared norm of the product's 0/1 vector."""
    return pairs.groupBy("product_id").agg(F.count(F.lit(1)).alias("buyers"))


def _sliced(pairs: DataFrame, cell: int) -> DataFrame:
    """Pairs with the product's buyers and the slice of the customer's basket it falls into."""
    # An aggregate on the join key would need no shuffle of its own, and then AQE could not split a hot
    # key's partition; written and read back, both sides of each join are shuffled and can be split.
    large = written(
        pairs.groupBy("customer_id")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).alias("slices"))
        .filter(F.col("slices") > 1), "large-baskets")
    buyers = written(product_buyers(pairs), "buyers")
    return (
        pairs.join(buyers, "product_id")
        .join(large, "customer_id", "left")
        .withColumn("slices", F.coalesce("slices", F.lit(1)))
        .withColumn("slice", F.pmod(F.xxhash64("product_id"), F.col("slices")))
    )


def _tasks(pairs: DataFrame) -> int:
    """Tasks for pairing the baskets: by the pairs to form."""
    spark = pairs.sparkSession
    size = F.col("size").cast("double")
    to_form = (
        pairs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("size"))
        .agg(F.sum(size * size / 2)).first()[0] or 0)
    return max(spark.sparkContext.defaultParallelism, ceil(to_form / PAIRS_PER_TASK))


def _cells(sliced: DataFrame, tasks: int) -> DataFrame:
    """One array of products per customer and pair of slices, from the least bought to the most.

    A basket of one slice is one cell. Of a larger basket, cell (r, c) holds the slices r and c, at
    most about two slices' worth. The work that follows is quadratic in the cell, not in its bytes:
    the explicit partition count keeps AQE from merging cells into a few tasks by their bytes, and
    the explicit keys keep a hot customer's cells from staying together.
    """
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("other")
    return (
        sliced.select("customer_id", "slice", other, F.struct("buyers", "product_id", "slice").alias("p"))
        .select("customer_id", F.least("slice", "other").alias("r"),
                F.greatest("slice", "other").alias("c"), "p")
        .repartition(tasks, "customer_id", "r", "c")
        .groupBy("customer_id", "r", "c").agg(F.sort_array(F.collect_list("p")).alias("basket"))
    )


def _neighbours(cells: DataFrame, both: bool) -> DataFrame:
    """``(product_id, buyers, ids, counts)`` per place of a product in a cell: the products it meets there and
    their customers, packed in two arrays.

    A pair stands with its less bought product, so that few rows meet at a hot one; with ``both``, with either
    one, and each product meets itself once per customer. Cells off the diagonal pair only products of
    different slices, so every pair of a customer stands there once.
    """
    own = F.col("own")
    met = F.col("basket") if both else F.slice("basket", F.col("at") + 2, F.size("basket"))
    met = F.when(F.col("r") == F.col("c"), met).otherwise(F.filter(met, lambda p: p["slice"] != own["slice"]))
    return (
        cells.select("r", "c", "basket", F.posexplode("basket").alias("at", "own"))
        .select(own["product_id"].alias("product_id"), own["buyers"].alias("buyers"), met.alias("met"))
        .filter(F.size("met") > 0)
        .select("product_id", "buyers", F.col("met.product_id").alias("ids"), F.col("met.buyers").alias("counts"))
    )


def _counted(neighbours: DataFrame, tasks: int | None) -> DataFrame:
    """``(product_id, other_id, shared, norm)`` of neighbours. With ``tasks`` the arrays of a product are dealt
    to that many tasks and counted there, so a pair is moved as two numbers of an array; without, pairs are
    counted before and after a shuffle."""
    if tasks is not None:
        neighbours = neighbours.repartition(tasks, "product_id")
    norm = F.sqrt(F.col("buyers").cast("double") * F.get("counts", F.col("at")).cast("double"))
    return (
        neighbours.select("product_id", "buyers", "counts", F.posexplode("ids").alias("at", "other_id"))
        .select("product_id", "other_id", norm.alias("norm"))
        .groupBy("product_id", "other_id")
        .agg(F.count(F.lit(1)).alias("shared"), F.max("norm").alias("norm"))
    )


def shared_by_product(pairs: DataFrame, cell: int = CELL, both: bool = True,
                      packed: int = PACKED_BUYERS) -> list[DataFrame]:
    """``(product_id, other_id, shared, norm)`` for every pair with a customer in common, in one direction or
    ``both``; then each product is its own neighbour too. ``norm`` is the product of both vectors' norms.

    A product is in one of the frames only. The first has those of up to ``packed`` customers, each in one
    task; the second, if there are any others, the hot ones. Each customer's basket is paired with itself in
    cells of bounded size, so no task holds a whole hot customer.
    """
    sliced, tasks = _sliced(pairs, cell), _tasks(pairs)
    neighbours = _neighbours(_cells(sliced, tasks), both)
    dealt = 2 * tasks if both else tasks
    if product_buyers(pairs).filter(F.col("buyers") > packed).isEmpty():
        return [_counted(neighbours, dealt)]
    neighbours = _neighbours(written(_cells(sliced, tasks), "cells"), both)
    return [_counted(neighbours.filter(F.col("buyers") <= packed), dealt),
            _counted(neighbours.filter(F.col("buyers") > packed), None)]


def shared_customers(pairs: DataFrame, cell: int = CELL, packed: int = PACKED_BUYERS) -> DataFrame:
    """``(product_a, product_b, shared, norm)`` for every pair a < b with a customer in common; ``norm`` is
    the product of both vectors' norms."""
    counted = reduce(DataFrame.unionByName, shared_by_product(pairs, cell, both=False, packed=packed))
    return counted.select(
        F.least("product_id", "other_id").alias("product_a"), F.greatest("product_id", "other_id").alias("product_b"),
        "shared", "norm")
