"""Item-to-item recommendation by cosine similarity over customer purchases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.joins import join_counted
from tradewind.operators.lineage import written
from tradewind.operators.overlap import (
    CELL, PACKED_BUYERS, product_buyers, shared_by_product, shared_customers,
)
from tradewind.operators.ranking import top_n_per_group
from tradewind.plans.orders import VALID_STATUS, order_lines

# Decimal places of a reported score. Ranking uses the unrounded score.
SCORE_DIGITS = 4


def purchases(orders: DataFrame, order_items: DataFrame, product_variants: DataFrame,
              products: DataFrame, valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """Customer, product id and product name of every line of a valid order."""
    return order_lines(orders, order_items, product_variants, products, valid_status).select(
        "customer_id", "product_id", "product_name")


def purchase_pairs(bought: DataFrame) -> DataFrame:
    """Who bought what, once each. Includes purchases without a customer."""
    return bought.select("customer_id", "product_id", "product_name").distinct()


def product_names(bought: DataFrame) -> DataFrame:
    """One name per product id, the smallest when an id has several."""
    return bought.groupBy("product_id").agg(F.min("product_name").alias("product_name"))


def user_item_matrix(bought: DataFrame) -> DataFrame:
    """The customer x product 0/1 matrix in long form, ones only. Anonymous purchases drop out."""
    return (
        bought.filter(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("bought"))
        .select("customer_id", "product_id", (F.col("bought") > 0).cast("int").alias("purchased"))
    )


def known_pairs(bought: DataFrame) -> DataFrame:
    """Distinct customer and product of every purchase by a known customer."""
    return (
        bought.select("customer_id", "product_id")
        .filter(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
        .distinct())


def matrix_shape(bought: DataFrame) -> DataFrame:
    """Rows and columns of the customer x product matrix.

    Two counts of their own: two distinct counts in one aggregation would double every pair before the shuffle.
    """
    pairs = written(known_pairs(bought), "pairs")
    customers, products = (
        pairs.select(c).filter(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1))) for c in ("customer_id", "product_id"))
    return bought.sparkSession.range(1).select(
        customers.scalar().alias("customers"), products.scalar().alias("products"))


def _cosine(shared: Column, norm: Column) -> Column:
    return shared.cast("double") / norm


def item_cosine(bought: DataFrame, cell: int = CELL) -> DataFrame:
    """Cosine similarity of every product pair a < b with a customer in common.

    All other pairs have similarity 0 and are left out.
    """
    pairs = written(known_pairs(bought), "pairs")
    score = _cosine(F.col("shared"), F.col("norm"))
    return shared_customers(pairs, cell).select(
        "product_a", "product_b", F.bround(score, SCORE_DIGITS).alias("cosine_similarity"))


def reference_product(pairs: DataFrame, products: DataFrame, product_name: str) -> tuple[int, int]:
    """Smallest product id with this name bought by a known customer, and its customers' number.

    Raises ``ValueError`` when there is none.
    """
    named = products.filter(F.col("name") == product_name).select(
        F.col("id").alias("product_id")).distinct()
    found = product_buyers(join_counted(pairs, named, "product_id", "left_semi")).orderBy(
        "product_id").first()
    if found is None:
        raise ValueError(f"no known customer bought a product named {product_name!r}")
    return found["product_id"], found["buyers"]


def product_scores(pairs: DataFrame, product_id: int, buyers: int) -> DataFrame:
    """Unrounded similarity of every other product to one product, 0 without a common customer.

    One left join marks the purchases of the reference's customers; one aggregation then counts
    each product's customers and the shared ones together. Linear in the purchases.
    """
    audience = pairs.filter(F.col("product_id") == product_id).select(
        "customer_id", F.lit(1).alias("common"))
    others = pairs.filter(F.col("product_id") != product_id)
    norm = F.sqrt(F.col("buyers").cast("double") * F.lit(float(buyers)))
    return (
        join_counted(others, audience, "customer_id", "left", rows=buyers)
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("buyers"), F.count("common").alias("shared"))
        .select("product_id", _cosine(F.col("shared"), norm).alias("score"))
    )


def similar_products(bought: DataFrame, products: DataFrame, product_name: str,
                     top_n: int = 5) -> DataFrame:
    """The ``top_n`` products most similar to the named one, ranked from 1; ties by product id.

    The winners are one array of ``top_n`` entries, evaluated once as a scalar subquery: it picks
    their names in a single scan of ``products`` without a shuffle.
    """
    pairs = written(known_pairs(bought), "pairs")
    reference, buyers = reference_product(pairs, products, product_name)
    best = (
        product_scores(pairs, reference, buyers)
        .orderBy(F.desc("score"), "product_id").limit(top_n)
        .agg(F.sort_array(F.collect_list(
            F.struct((-F.col("score")).alias("below"), "product_id"))).alias("best"))
        .scalar())
    names = (
        products.filter(F.array_contains(best["product_id"], F.col("id")))
        .groupBy("id").agg(F.min("name").alias("name"))
        .agg(F.map_from_entries(F.collect_list(F.struct("id", "name"))))
        .scalar())
    return (
        bought.sparkSession.range(1).select(F.posexplode(best).alias("above", "hit"))
        .select(
            (F.col("above") + 1).alias("rank"), F.col("hit.product_id").alias("product_id"),
            F.coalesce(F.try_element_at(names, F.col("hit.product_id")), F.lit("?")).alias("product_name"),
            F.bround(-F.col("hit.below"), SCORE_DIGITS).alias("cosine_similarity")))


def _best_of_each(counted: DataFrame, top_n: int) -> DataFrame:
    """``(product_id, best)``: the ``top_n`` neighbours of each product as an array, the best first.

    A product stands first among its neighbours, so that one without any other has an empty array.
    """
    score, itself = _cosine(F.col("shared"), F.col("norm")), F.col("other_id") == F.col("product_id")
    order = [itself.desc(), F.desc("score"), F.asc("other_id")]
    nearest = top_n_per_group(counted.withColumn("score", score), ["product_id"], order, top_n + 1)
    hit = F.when(~itself, F.struct((-F.col("score")).alias("below"), F.col("other_id").alias("similar_id")))
    return nearest.groupBy("product_id").agg(F.sort_array(F.collect_list(hit)).alias("best"))


def similar_products_all(bought: DataFrame, top_n: int = 5, cell: int = CELL, packed: int = PACKED_BUYERS) -> DataFrame:
    """The ``top_n`` most similar products of every product.

    A product with fewer than ``top_n`` related products is filled up with score 0 in id order. The
    first ``top_n + 1`` ids always suffice: besides the product itself and its related products,
    enough of them are left.
    """
    pairs = written(known_pairs(bought), "pairs")
    first_ids = (
        product_buyers(pairs).select("product_id").orderBy("product_id").limit(top_n + 1)
        .agg(F.collect_list("product_id").alias("ids")).scalar())
    best = reduce(DataFrame.unionByName, [
        _best_of_each(counted, top_n) for counted in shared_by_product(pairs, cell, packed=packed)])
    # Filled up as arrays, a product at a time, so that only the best are held and nothing is shuffled again.
    unrelated = F.transform(
        F.filter("first_ids", lambda id_: (id_ != F.col("product_id")) & ~F.array_contains("best.similar_id", id_)),
        lambda id_: F.struct(F.lit(-0.0).alias("below"), id_.alias("similar_id")))
    return (
        best.withColumn("first_ids", first_ids)
        .withColumn("best", F.slice(F.concat("best", unrelated), 1, top_n))
        .select("product_id", F.posexplode("best").alias("above", "hit"))
        .select("product_id", (F.col("above") + 1).alias("rank"), F.col("hit.similar_id").alias("similar_id"),
                F.bround(-F.col("hit.below"), SCORE_DIGITS).alias("cosine_similarity")))
