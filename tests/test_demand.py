import datetime as dt

import pytest
from pyspark.sql import functions as F

import shop
from tradewind.operators.series import recursive_mean
from tradewind.plans import demand as jobs


def day(text):
    return dt.date.fromisoformat(f"{text}-01")


def series(spark, name, first, values):
    start = dt.date.fromisoformat(f"{first}-01")
    months = [(start.year * 12 + start.month - 1 + i) for i in range(len(values))]
    return spark.createDataFrame(
        [(name, dt.date(m // 12, m % 12 + 1, 1), v) for m, v in zip(months, values)],
        "product_name string, month date, quantity bigint")


@pytest.mark.parametrize("history, expected", [
    ([6], [6, 4, 16 / 3]),
    ([6, 9], [7.5, 7.5, 8]),
    ([10, 0, 30, 40, 50], [40, 130 / 3, (50 + 40 + 130 / 3) / 3]),
    ([], [None, None, None]),
])
def test_recursion(spark, history, expected):
    values = F.array(*map(F.lit, history)).cast("array<double>")
    got = spark.range(1).select(recursive_mean(values, 3, 3).alias("f")).first().f
    assert got == pytest.approx(expected) if expected[0] is not None else got == expected


def test_longer_horizon_runs_on_forecasts(spark):
    values = F.array(F.lit(3.0), F.lit(6.0))
    got = spark.range(1).select(recursive_mean(values, 4, 2).alias("f")).first().f
    assert got == [4.5, 5.25, 4.875, 5.0625]


def shop_data(spark):
    orders = shop.orders(spark, [
        (1, 1, 1, "2024-01-31"), (2, 1, 1, "2024-04-01"), (3, 1, 1, "2024-04-30", "confirmed"),
        (4, 1, 1, "2024-09-01", "cancelled"), (5, 1, 1, "2024-02-10")])
    items = shop.items(spark, [(1, 101, 2), (2, 102, 3), (3, 101, 4), (4, 101, 9), (5, 103, 1), (5, 103, None)])
    return orders, items, *shop.catalog(spark, [(1, "rope", 7), (2, "rope", 8), (3, "sail", 8), (4, None, 8)])


def test_monthly_demand_is_dense_and_merges_names(spark):
    got = shop.tuples(jobs.monthly_demand(*shop_data(spark)).orderBy("product_name", "month"))
    assert got == [("rope", day("2024-01"), 2), ("rope", day("2024-02"), 0), ("rope", day("2024-03"), 0),
                   ("rope", day("2024-04"), 7), ("sail", day("2024-02"), 1)]


def test_one_name_equals_its_part_of_all(spark):
    data = shop_data(spark)
    one = jobs.monthly_demand(*data, product_name="rope").orderBy("month")
    every = jobs.monthly_demand(*data).filter("product_name = 'rope'").orderBy("month")
    assert shop.tuples(one) == shop.tuples(every)
    assert jobs.monthly_demand(*data, product_name="none").count() == 0


def test_product_lines_ignore_the_order_state(spark):
    _, items, variants, products = shop_data(spark)
    got = sorted(shop.tuples(jobs.product_lines(items, variants, products, "rope")))
    assert got == [(1, 1, 2), (2, 2, 3), (3, 1, 4), (4, 1, 9)]


def test_evaluation(spark):
    monthly = series(spark, "rope", "2025-08", [10, 0, 30, 40, 50, 43, 40])
    rows = shop.tuples(jobs.forecast_eval(monthly).orderBy("month"))
    assert rows == [("rope", day("2026-01"), 40.0, 43, 3.0), ("rope", day("2026-02"), 43.33, 40, 3.33),
                    ("rope", day("2026-03"), 44.44, None, None)]
    metrics = jobs.forecast_metrics(monthly).first()
    assert metrics.mae == pytest.approx((3.0 + 3.33) / 2)
    assert metrics.train_mean == 26.0
    assert metrics.mae_ratio == pytest.approx(metrics.mae / 26)
    assert metrics.forecast_total == 128  # 127.77


def test_no_training_month_and_zero_mean(spark):
    late = series(spark, "late", "2026-01", [5])
    assert shop.tuples(jobs.ma_forecast(late).select("forecast")) == [(None,)] * 3
    assert tuple(jobs.forecast_metrics(late).first()) == ("late", None, None, None, None)
    zero = jobs.forecast_metrics(series(spark, "zero", "2025-12", [0, 1])).first()
    assert (zero.mae, zero.train_mean, zero.mae_ratio) == (1.0, 0.0, None)


def test_half_even_total(spark):
    # Forecasts 0.5, 0.17, 0.22 … the total rounds half to even like the single values.
    monthly = series(spark, "a", "2025-11", [1, 4])
    assert jobs.forecast_metrics(monthly).first().forecast_total == round(2.5 + 2.17 + 2.89)
