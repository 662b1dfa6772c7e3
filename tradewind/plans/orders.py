"""Orders: valid orders, order lines, overview and row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The order states that count as a sale.
VALID_STATUS = ("paid", "confirmed")


def valid_orders(orders: DataFrame, valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """Orders in a state that counts as a sale, all columns."""
    return orders.filter(F.col("status").isin(*valid_status))


def catalog(product_variants: DataFrame, products: DataFrame) -> DataFrame:
    """Variants with their product's id, name and category.

    Joined before it meets the order lines, so that the lines are shuffled once for the catalog and
    not once per dimension.
    """
    variants = product_variants.select(F.col("id").alias("product_variant_id"), "product_id")
    named = products.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), "category_id")
    return variants.join(named, "product_id")


def order_lines(orders: DataFrame, order_items: DataFrame, product_variants: DataFrame,
                products: DataFrame, valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """One row per line of a valid order with its customer, product and category."""
    valid = valid_orders(orders, valid_status).select(
        F.col("id").alias("order_id"), "customer_id", "placed_at")
    items = order_items.select("order_id", "product_variant_id", "quantity")
    return (
        items.join(valid, "order_id")
        .join(catalog(product_variants, products), "product_variant_id")
        .select("order_id", "customer_id", "placed_at", "product_id", "product_name", "category_id",
                "quantity")
    )


def orders_overview(orders: DataFrame) -> DataFrame:
    """Row count, first and last creation, smallest, largest and average total.

    The average is one division rounded once: Spark's own ``avg`` of a decimal already rounds.
    """
    return orders.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("created_at").alias("min_date"),
        F.max("created_at").alias("max_date"),
        F.min("total").alias("min_total"),
        F.max("total").alias("max_total"),
        F.round(F.sum("total") / F.nullif(F.count("total"), F.lit(0)), 2).alias("avg_total"),
    )


def row_count_breakdown(customers: DataFrame, orders: DataFrame, order_items: DataFrame,
                        payments: DataFrame) -> DataFrame:
    """Rows of the four loaded tables and their sum, as one row."""
    return customers.sparkSession.sql(
        """
        SELECT *, customers_total + orders_total + order_items_total + payments_total AS sum_total
        FROM (SELECT (SELECT count(*) FROM {customers}) AS customers_total,
                     (SELECT count(*) FROM {orders}) AS orders_total,
                     (SELECT count(*) FROM {order_items}) AS order_items_total,
                     (SELECT count(*) FROM {payments}) AS payments_total)
        """,
        customers=customers, orders=orders, order_items=order_items, payments=payments,
    )


def row_count_total(customers: DataFrame, orders: DataFrame, order_items: DataFrame,
                    payments: DataFrame) -> DataFrame:
    """Rows of the four loaded tables, as one number."""
    return row_count_breakdown(customers, orders, order_items, payments).select(
        F.col("sum_total").alias("total_rows"))
