"""A small shop: orders, items, variants and products as DataFrames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

ORDERS = ("id int, customer_id int, status string, channel string, total decimal(18,2),"
          " placed_at timestamp_ntz, created_at timestamp_ntz")
ITEMS = "order_id int, product_variant_id int, quantity int"
VARIANTS = "id int, product_id int"
PRODUCTS = "id int, name string, category_id int"
CATEGORIES = "id int, name string"


def when(day: str) -> dt.datetime:
    return dt.datetime.fromisoformat(day)


def orders(spark, rows):
    """Rows (id, customer, total, day[, status[, channel]])."""
    full = []
    for id_, customer, total, day, *rest in rows:
        status = rest[0] if rest else "paid"
        channel = rest[1] if len(rest) > 1 else "pos"
        money = None if total is None else Decimal(str(total))
        full.append((id_, customer, status, channel, money, when(day), when(day)))
    return spark.createDataFrame(full, ORDERS)


def items(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def catalog(spark, products):
    """Variants and products from rows (product id, name, category); variant id = 100 + product."""
    variants = spark.createDataFrame([(100 + p, p) for p, *_ in products], VARIANTS)
    return variants, spark.createDataFrame(products, PRODUCTS)


def tuples(df):
    return [tuple(row) for row in df.collect()]
