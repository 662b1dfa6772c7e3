"""Customers: revenue, ticket, category diversity, the elite and their favourite category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tradewind.operators.joins import join_counted
from tradewind.plans.orders import VALID_STATUS, catalog, order_lines, valid_orders

# Categories of a shop that are counted by bits of longs; beyond that they are counted as distinct rows.
BIT_CATEGORIES = 1024
WORD_BITS = 64


def customer_metrics(orders: DataFrame, valid_status: tuple[str, ...] = VALID_STATUS,
                     round_ticket: bool = True) -> DataFrame:
    """Revenue, number of distinct orders and average ticket per customer.

    A repeated order id counts once in the frequency but every time in the revenue. The distinct
    count runs on (customer, order) first, so a customer with a large share of all orders is spread
    over the tasks.
    """
    ticket = F.sum("total") / F.nullif(F.count_distinct("id"), F.lit(0))
    return valid_orders(orders, valid_status).groupBy("customer_id").agg(
        F.sum("total").alias("revenue"),
        F.count_distinct("id").alias("frequency"),
        (F.round(ticket, 2) if round_ticket else ticket).alias("avg_ticket"),
    )


def category_diversity(orders: DataFrame, order_items: DataFrame, product_variants: DataFrame,
                       products: DataFrame,
                       valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """Distinct categories bought per customer."""
    lines = order_lines(orders, order_items, product_variants, products, valid_status)
    return lines.groupBy("customer_id").agg(
        F.count_distinct("category_id").alias("category_count"))


def _category_rows(goods: DataFrame, at_most: int) -> dict | None:
    """Variants per category; None when there are more than ``at_most`` categories."""
    found = goods.groupBy("category_id").count().limit(at_most + 2).collect()
    rows = {r["category_id"]: r["count"] for r in found}
    return rows if len(rows.keys() - {None}) <= at_most else None


def _bits(place: Column, word: int) -> Column:
    """The bit of ``place`` when it lies in this word of a bit set, else NULL."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place - word * WORD_BITS)
    return F.when((place >= word * WORD_BITS) & (place < (word + 1) * WORD_BITS), bit)


def _metrics_and_diversity(orders: DataFrame, order_items: DataFrame, goods: DataFrame, rows: dict,
                           valid_status: tuple[str, ...], round_ticket: bool) -> DataFrame:
    """``customer_metrics`` and ``category_diversity`` of customers with order lines, from one reading of the
    orders and one exchange by customer.

    Each order gets the set of its categories, as bits of a few longs; the customers' sets are merged beside
    the sums. A catalog that was counted as small is broadcast, so that the lines are merged by order before
    their one shuffle. The join by order brings equal order ids together, so counting them apart takes no
    exchange of its own.
    """
    categories = sorted(rows.keys() - {None})
    words = [f"categories_{k}" for k in range(max(1, -(-len(categories) // WORD_BITS)))]
    known = F.array(*map(F.lit, categories)).cast(ArrayType(goods.schema["category_id"].dataType))
    place = (F.array_position(known, F.col("category_id")) - 1).cast("int").alias("place")  # NULL without a category
    by_order = (
        join_counted(order_items.select("order_id", "product_variant_id"), goods.select("product_variant_id", place),
                     "product_variant_id", rows=sum(rows.values()))
        .groupBy("order_id").agg(*[F.bit_or(_bits(F.col("place"), k)).alias(w) for k, w in enumerate(words)]))
    ticket = F.sum("total") / F.nullif(F.count_distinct("id"), F.lit(0))
    count = sum((F.coalesce(F.bit_count(F.bit_or(w)), F.lit(0)) for w in words), F.lit(0))
    return (
        valid_orders(orders, valid_status).select("id", "customer_id", "total").filter(F.col("customer_id").isNotNull())
        .join(by_order, F.col("id") == F.col("order_id"), "left")
        .groupBy("customer_id").agg(
            F.sum("total").alias("revenue"), F.count_distinct("id").alias("frequency"),
            (F.round(ticket, 2) if round_ticket else ticket).alias("avg_ticket"),
            count.cast("bigint").alias("category_count"), F.count("order_id").alias("with_lines"))
        .filter(F.col("with_lines") > 0).drop("with_lines"))


def elite_customers(orders: DataFrame, order_items: DataFrame, product_variants: DataFrame,
                    products: DataFrame, *, valid_status: tuple[str, ...] = VALID_STATUS,
                    min_categories: int = 13, top_n: int = 10, round_ticket: bool = True,
                    bit_categories: int = BIT_CATEGORIES) -> DataFrame:
    """The customers with the highest average ticket among those with enough categories.

    ``round_ticket`` decides whether tickets are ranked after or before rounding to cents; the two
    can pick different customers. A NULL ticket ranks first. Up to ``bit_categories`` categories are
    counted by bits, more as distinct rows.
    """
    goods = catalog(product_variants, products).select("product_variant_id", "category_id")
    rows = _category_rows(goods, bit_categories)
    if rows is not None:
        found = _metrics_and_diversity(orders, order_items, goods, rows, valid_status, round_ticket)
    else:
        found = customer_metrics(orders, valid_status, round_ticket).join(
            category_diversity(orders, order_items, product_variants, products, valid_status), "customer_id")
    return (
        found.filter(F.col("category_count") >= min_categories)
        .select("customer_id", "revenue", "frequency", "avg_ticket", "category_count")
        .orderBy(F.desc_nulls_first("avg_ticket"), F.asc("customer_id"))
        .limit(top_n)
    )


def elite_top_category(orders: DataFrame, order_items: DataFrame, product_variants: DataFrame,
                       products: DataFrame, categories: DataFrame, *,
                       valid_status: tuple[str, ...] = VALID_STATUS, min_categories: int = 13,
                       top_n: int = 10) -> DataFrame:
    """The category of which the elite bought most, the elite ranked by unrounded tickets.

    The elite is a report of ``top_n`` rows, so it is broadcast to the orders; whether the elite's
    orders are broadcast to the order lines is decided by their size, at run time.
    """
    elite = elite_customers(
        orders, order_items, product_variants, products, valid_status=valid_status,
        min_categories=min_categories, top_n=top_n, round_ticket=False).select("customer_id")
    their_orders = (
        valid_orders(orders, valid_status).join(F.broadcast(elite), "customer_id", "left_semi")
        .select(F.col("id").alias("order_id")))
    items = order_items.select("order_id", "product_variant_id", "quantity")
    bought = (
        items.join(their_orders, "order_id")
        .join(catalog(product_variants, products), "product_variant_id")
        .groupBy("category_id").agg(F.sum("quantity").alias("quantity")))
    named = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    return (
        bought.join(named, "category_id")
        .groupBy("category_id", "category").agg(F.sum("quantity").alias("total_quantity"))
        .orderBy(F.desc_nulls_first("total_quantity"), F.asc("category_id"))
        .limit(1)
    )
