"""Sales per day and weekday over a complete calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.calendar import calendar_dim
from tradewind.plans.orders import VALID_STATUS, valid_orders


def daily_sales(orders: DataFrame, channel: str = "pos",
                valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """Sales of one channel per day, days with a valid order only."""
    return (
        valid_orders(orders, valid_status).filter(F.col("channel") == channel)
        .groupBy(F.col("placed_at").cast("date").alias("date"))
        .agg(F.sum("total").alias("sales"))
    )


def calendar_sales(orders: DataFrame, channel: str = "pos",
                   valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """Sales for every calendar day; the calendar spans all orders, days without a sale have 0."""
    return (
        calendar_dim(orders).join(daily_sales(orders, channel, valid_status), "date", "left")
        .withColumn("sales", F.coalesce("sales", F.lit(0).cast("decimal(18,2)")))
    )


def weekday_sales(orders: DataFrame, channel: str = "pos",
                  valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """Days, days with sales above 0, average and total sales per weekday, lowest average first."""
    return (
        calendar_sales(orders, channel, valid_status)
        .groupBy("weekday_number", "weekday_name")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.count_if(F.col("sales") > 0).alias("days_with_sale"),
            F.round(F.sum("sales") / F.count(F.lit(1)), 2).alias("avg_sales"),
            F.round(F.sum("sales"), 2).alias("total_sales"),
        )
        .orderBy("avg_sales", "weekday_number")
    )
