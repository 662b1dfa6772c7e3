"""Dates: weekdays, months and dense spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday names, Sunday first (weekday number 0).
WEEKDAY_NAMES = (
    "Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado",
)


def weekday_number(date: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(date) - 1


def weekday_name(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAY_NAMES)), number + 1)


def month_of(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(moment, "MM")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def month_distance(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def date_spine(bounds: DataFrame, first: str, last: str, name: str = "date") -> DataFrame:
    """One row per day from ``first`` to ``last`` inclusive; none when a bound is NULL."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))


def calendar_dim(orders: DataFrame) -> DataFrame:
    """Every day between the first and last order placed, whatever the order's channel or status."""
    bounds = orders.agg(
        F.min("placed_at").cast("date").alias("first_day"),
        F.max("placed_at").cast("date").alias("last_day"),
    )
    return (
        date_spine(bounds, "first_day", "last_day")
        .withColumn("weekday_number", weekday_number(F.col("date")))
        .withColumn("weekday_name", weekday_name(F.col("weekday_number")))
    )
