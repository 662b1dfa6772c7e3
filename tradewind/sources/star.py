"""The benchmark's star-schema Parquet tables under the retail column names.

The benchmark has no product variants, categories or sales channels: parts stand for products and
their variants, brands for categories, the most urgent priority for the point-of-sale channel, and
the order states F and O for the states that count as a sale.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VALID_STATUS = ("F", "O")
CHANNEL = "1-URGENT"
CUTOFF = "2000-12"
PRODUCT_NAME = "blue anvil"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Retail:
    """The canonical tables as lazy projections; a Parquet file is opened when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._read = lambda name: read_table(spark, folder, name)

    @cached_property
    def customers(self) -> DataFrame:
        return self._read("customer").select(F.col("c_custkey").alias("id"))

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("channel"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
            F.col("o_orderdate").alias("placed_at"),
            F.col("o_orderdate").alias("created_at"))

    @cached_property
    def order_items(self) -> DataFrame:
        return self._read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_variant_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"))

    @cached_property
    def _part(self) -> DataFrame:
        return self._read("part")

    @cached_property
    def product_variants(self) -> DataFrame:
        return self._part.select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("product_id"))

    @cached_property
    def products(self) -> DataFrame:
        return self._part.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("category_id"))

    @cached_property
    def categories(self) -> DataFrame:
        return self._part.select(
            F.col("p_brand").alias("id"), F.col("p_brand").alias("name")).distinct()

    @cached_property
    def payments(self) -> DataFrame:
        return self._read("events").select(F.col("event_id").alias("id"))

    def register(self) -> None:
        """Make the canonical tables temporary views, for use in SQL."""
        for name in ("customers", "orders", "order_items", "product_variants", "products", "categories",
                     "payments"):
            getattr(self, name).createOrReplaceTempView(name)
