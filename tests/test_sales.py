import datetime as dt
from decimal import Decimal

import shop
from tradewind.functions.calendar import calendar_dim
from tradewind.plans import sales as jobs


def orders(spark):
    return shop.orders(spark, [
        (1, 1, 10, "2024-01-07"),                        # Sunday
        (2, 1, 5, "2024-01-08", "paid", "web"),          # Monday, another channel
        (3, 1, 7, "2024-01-10", "cancelled"),            # Wednesday, not a sale
        (4, 1, 0, "2024-01-14", "confirmed"),            # Sunday, worth 0
        (5, 1, 2.50, "2024-01-15", "confirmed"),         # Monday
        (6, 1, 1, "2024-01-16", "paid", "web")])


def test_calendar_spans_all_orders(spark):
    days = shop.tuples(calendar_dim(orders(spark)).orderBy("date"))
    assert len(days) == 10
    assert days[0] == (dt.date(2024, 1, 7), 0, "Domingo")
    assert days[6] == (dt.date(2024, 1, 13), 6, "Sábado")
    assert days[-1][0] == dt.date(2024, 1, 16)


def test_calendar_of_no_orders(spark):
    assert calendar_dim(orders(spark).limit(0)).count() == 0


def test_days_without_sales_are_zero(spark):
    got = {r.date.day: r.sales for r in jobs.calendar_sales(orders(spark)).collect()}
    assert got == {d: Decimal(0) for d in range(7, 17)} | {7: Decimal("10.00"), 15: Decimal("2.50")}


def test_weekdays(spark):
    rows = jobs.weekday_sales(orders(spark)).collect()
    assert sum(r.days for r in rows) == 10
    got = {r.weekday_number: (r.days, r.days_with_sale, r.avg_sales, r.total_sales) for r in rows}
    assert got[0] == (2, 1, Decimal("5.00"), Decimal("10.00"))  # the day worth 0 has no sale
    assert got[1] == (2, 1, Decimal("1.25"), Decimal("2.50"))
    assert got[3] == (1, 0, Decimal(0), Decimal(0))
    averages = [r.avg_sales for r in rows]
    assert averages == sorted(averages)
