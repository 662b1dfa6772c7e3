"""Monthly series: gap filling and the recursive moving average."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_months(sparse: DataFrame, key: str, value: str) -> DataFrame:
    """Make each key's ``month`` series dense: absent months between first and last get 0.

    ``sparse`` holds one row per key and month. Each row emits itself plus the empty months up to
    the next row, so no spine is joined and nothing but the next month is looked at.
    """
    following = F.lead("month").over(Window.partitionBy(key).orderBy("month"))
    reach = F.coalesce(F.add_months(following, -1), F.col("month"))
    return (
        sparse.withColumn("reach", reach)
        .select(key, value, F.col("month").alias("sold"),
                F.explode(F.sequence("month", "reach", F.expr("interval 1 month"))).alias("month"))
        .select(key, "month",
                F.when(F.col("month") == F.col("sold"), F.col(value)).otherwise(0).alias(value))
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _last(values: Column, n: Column) -> Column:
    """The last ``n`` elements, or all of them when there are fewer."""
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)


def recursive_mean(history: Column, horizon: int, window: int) -> Column:
    """``horizon`` forecasts by a moving average that feeds on its own forecasts.

    The first step is the mean of the last ``window`` values, or of those that exist. Each later
    step adds the remaining history and the forecasts so far and divides by ``window``, also when
    the history is shorter than that. An empty history forecasts NULL.
    """

    def extend(forecasts: Column, step: Column) -> Column:
        own = _last(history, F.greatest(F.lit(window) - step + 1, F.lit(0)))
        prior = _last(forecasts, F.lit(window))
        divisor = F.when(step == 1, F.size(own)).otherwise(F.lit(window))
        mean = _total(F.concat(own, prior)) / F.nullif(divisor, F.lit(0))
        return F.concat(forecasts, F.array(mean))

    steps = F.sequence(F.lit(1), F.lit(horizon))
    return F.aggregate(steps, F.array().cast("array<double>"), extend)
