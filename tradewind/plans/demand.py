"""Monthly demand per product name, its moving-average forecast and the hold-out evaluation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.calendar import month_distance, month_of
from tradewind.operators.joins import join_counted
from tradewind.operators.series import fill_months, recursive_mean
from tradewind.plans.orders import VALID_STATUS, order_lines

# The last month used for training and the length of the moving average and horizon.
CUTOFF = "2025-12"
WINDOW = 3
HORIZON = 3


def _named_variants(product_variants: DataFrame, products: DataFrame,
                    product_name: str) -> DataFrame:
    named = products.filter(F.col("name") == product_name).select(F.col("id").alias("product_id"))
    variants = product_variants.select(F.col("id").alias("product_variant_id"), "product_id")
    return join_counted(variants, named, "product_id", "left_semi")


def product_lines(order_items: DataFrame, product_variants: DataFrame, products: DataFrame,
                  product_name: str) -> DataFrame:
    """Order lines of every product with the given name, whatever the order's state."""
    items = order_items.select("order_id", "product_variant_id", "quantity")
    variants = _named_variants(product_variants, products, product_name)
    return join_counted(items, variants, "product_variant_id").select(
        "order_id", "product_id", "quantity")


def monthly_demand(orders: DataFrame, order_items: DataFrame, product_variants: DataFrame,
                   products: DataFrame, product_name: str | None = None,
                   valid_status: tuple[str, ...] = VALID_STATUS) -> DataFrame:
    """Quantity sold per product name and month, dense from a name's first to its last sale.

    Products that share a name are one series. Without ``product_name`` every name is computed;
    with it the order lines are first cut down to that name's.
    """
    if product_name is not None:
        variants = _named_variants(product_variants, products, product_name)
        order_items = join_counted(
            order_items, variants.select("product_variant_id"), "product_variant_id", "left_semi")
        products = products.filter(F.col("name") == product_name)
    lines = order_lines(orders, order_items, product_variants, products, valid_status)
    sold = (
        lines.filter(F.col("product_name").isNotNull() & F.col("placed_at").isNotNull())
        .groupBy("product_name", month_of(F.col("placed_at")).alias("month"))
        .agg(F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("quantity")))
    return fill_months(sold, "product_name", "quantity")


def _cutoff(month: str) -> Column:
    return F.lit(dt.datetime.strptime(month, "%Y-%m").date())


def _by_name(monthly: DataFrame, cutoff: str, window: int, horizon: int) -> DataFrame:
    """One row per name: training history, forecasts and actuals, from one pass over the series.

    The arrays hold one entry per month, so their size follows the calendar and not the sales.
    """
    ahead = month_distance(F.col("month"), _cutoff(cutoff))
    quantity = F.col("quantity").cast("double")
    trained = F.when(ahead <= 0, F.struct("month", quantity.alias("quantity")))
    actual = [F.sum(F.when(ahead == step, F.col("quantity"))).alias(f"actual_{step}")
              for step in range(1, horizon + 1)]
    history = F.transform("trained", lambda entry: entry["quantity"])
    return (
        monthly.groupBy("product_name")
        .agg(F.sort_array(F.collect_list(trained)).alias("trained"), *actual)
        .select("product_name", history.alias("history"),
                F.array(*[f"actual_{step}" for step in range(1, horizon + 1)]).alias("actuals"))
        .withColumn("forecasts", recursive_mean(F.col("history"), horizon, window))
    )


def _steps(by_name: DataFrame, cutoff: str) -> DataFrame:
    month = F.add_months(_cutoff(cutoff), F.col("step") + 1)
    return (
        by_name.select("product_name", F.posexplode(F.arrays_zip("forecasts", "actuals")).alias("step", "pair"))
        .select("product_name", month.alias("month"), F.col("pair.forecasts").alias("forecast"),
                F.col("pair.actuals").alias("actual"))
    )


def ma_forecast(monthly: DataFrame, cutoff: str = CUTOFF, window: int = WINDOW,
                horizon: int = HORIZON) -> DataFrame:
    """Unrounded forecasts for the months after ``cutoff``, per product name."""
    return _steps(_by_name(monthly, cutoff, window, horizon), cutoff).select(
        "product_name", "month", "forecast")


def forecast_eval(monthly: DataFrame, cutoff: str = CUTOFF, window: int = WINDOW,
                  horizon: int = HORIZON) -> DataFrame:
    """Forecast, actual quantity and absolute error per name and month.

    The error uses the unrounded forecast; forecast and error are then rounded half-even. A month
    outside the name's series has no actual and no error.
    """
    error = F.abs(F.col("forecast") - F.col("actual"))
    return _steps(_by_name(monthly, cutoff, window, horizon), cutoff).select(
        "product_name", "month", F.bround("forecast", 2).alias("forecast"), "actual",
        F.bround(error, 2).alias("abs_error"))


def _mean(values: Column) -> Column:
    """Mean of an array's non-NULL entries, added in order; NULL when there are none."""
    present = F.filter(values, lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)
    return total / F.nullif(F.size(present), F.lit(0))


def forecast_metrics(monthly: DataFrame, cutoff: str = CUTOFF, window: int = WINDOW,
                     horizon: int = HORIZON) -> DataFrame:
    """Per name: mean rounded error, mean training month, their ratio, total of rounded forecasts."""
    errors = F.zip_with("forecasts", "actuals", lambda f, a: F.bround(F.abs(f - a), 2))
    rounded = F.transform("forecasts", lambda f: F.bround(f, 2))
    total = F.aggregate(rounded, F.lit(0.0), lambda acc, x: acc + x)
    return (
        _by_name(monthly, cutoff, window, horizon)
        .select("product_name", _mean(errors).alias("mae"), _mean(F.col("history")).alias("train_mean"),
                F.bround(total, 0).cast("bigint").alias("forecast_total"))
        .withColumn("mae_ratio", F.try_divide("mae", "train_mean"))
        .select("product_name", "mae", "train_mean", "mae_ratio", "forecast_total")
    )
