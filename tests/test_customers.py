import random
from decimal import Decimal

import shop
from tradewind.plans import customers as jobs


def metrics(spark, rows, **options):
    return {r.customer_id: r for r in jobs.customer_metrics(shop.orders(spark, rows), **options).collect()}


def test_repeated_order_id(spark):
    got = metrics(spark, [(1, 1, 10, "2024-01-01"), (1, 1, 10, "2024-01-01"), (2, 1, 5, "2024-01-02")])
    assert (got[1].revenue, got[1].frequency, got[1].avg_ticket) == (Decimal("25.00"), 2, Decimal("12.50"))


def test_rounding_is_half_up(spark):
    rows = [(1, 1, 2.01, "2024-01-01"), (2, 1, 0, "2024-01-01"), (3, 2, 1.99, "2024-01-01")]
    assert metrics(spark, rows)[1].avg_ticket == Decimal("1.01")
    assert metrics(spark, rows, round_ticket=False)[1].avg_ticket == Decimal("1.005")


def elite_shop(spark, orders):
    """Every customer buys one unit of product 1, the first order of each also product 2."""
    items = [(o[0], 101, 1) for o in orders] + [(o[0], 102, 5) for o in orders]
    return shop.orders(spark, orders), shop.items(spark, items), *shop.catalog(
        spark, [(1, "rope", 7), (2, "sail", 8)])


def test_rounded_and_unrounded_tickets_rank_differently(spark):
    # Tickets 1.004 (customer 1) and 1.00 (customer 2) are equal only after rounding.
    orders = [(i, 1, 1.02 if i == 0 else 1.00, "2024-01-01") for i in range(5)] + [(9, 0, 1.00, "2024-01-01")]
    data = elite_shop(spark, orders)
    rounded = jobs.elite_customers(*data, min_categories=2, top_n=2)
    exact = jobs.elite_customers(*data, min_categories=2, top_n=2, round_ticket=False)
    assert [r.customer_id for r in rounded.collect()] == [0, 1]
    assert [r.customer_id for r in exact.collect()] == [1, 0]


def test_null_ticket_ranks_first_and_null_customer_drops(spark):
    data = elite_shop(spark, [(1, 1, None, "2024-01-01"), (2, 2, 9, "2024-01-01"), (3, None, 99, "2024-01-01")])
    rows = shop.tuples(jobs.elite_customers(*data, min_categories=2))
    assert [(r[0], r[3], r[4]) for r in rows] == [(1, None, 2), (2, Decimal("9.00"), 2)]


def test_bits_and_distinct_rows_count_alike(spark):
    """150 categories (three longs), repeated and unknown orders, lines without category, customers without lines."""
    rng = random.Random(5)
    orders = [(i % 190, rng.choice([None, *range(1, 12)]), rng.randrange(1, 500) / 100, "2024-01-01",
               rng.choice(["paid", "paid", "open"])) for i in range(220)] + [(500, 50, 1, "2024-01-01"), (501, 51, 2, "2024-01-01")]
    items = [(rng.randrange(200), 100 + rng.randrange(400), 1) for _ in range(3000)] + [(501, 100 + 400, 1), (None, 101, 1)]
    goods = [(p, f"product {p}", 10_000_000 + 3 * (p % 150)) for p in range(400)] + [(400, "loose", None)]
    data = shop.orders(spark, orders), shop.items(spark, items), *shop.catalog(spark, goods)
    for least in (0, 1, 90, 120):
        bits = jobs.elite_customers(*data, min_categories=least, top_n=100)
        assert shop.tuples(bits) == shop.tuples(jobs.elite_customers(*data, min_categories=least, top_n=100, bit_categories=149))
    assert {r[0]: r[4] for r in shop.tuples(jobs.elite_customers(*data, min_categories=0, top_n=100))}.get(51) == 0
    empty = data[0], data[1], data[2], data[3].limit(0)
    assert shop.tuples(jobs.elite_customers(*empty, min_categories=0)) == []


def test_category_threshold(spark):
    orders = shop.orders(spark, [(1, 1, 9, "2024-01-01"), (2, 2, 5, "2024-01-01")])
    items = shop.items(spark, [(1, 101, 1), (2, 101, 1), (2, 102, 1)])
    data = orders, items, *shop.catalog(spark, [(1, "rope", 7), (2, "sail", 8)])
    assert [r.customer_id for r in jobs.elite_customers(*data, min_categories=2).collect()] == [2]
    assert shop.tuples(jobs.category_diversity(*data).orderBy("customer_id")) == [(1, 1), (2, 2)]


def test_top_category_counts_the_elite_only(spark):
    orders = shop.orders(spark, [(1, 1, 9, "2024-01-01"), (2, 2, 50, "2024-01-01"), (3, 2, 50, "2024-01-01", "open")])
    items = shop.items(spark, [(1, 101, 99), (1, 102, 1), (2, 101, 1), (2, 102, 2), (3, 101, 99)])
    variants, products = shop.catalog(spark, [(1, "rope", 7), (2, "sail", 8)])
    categories = spark.createDataFrame([(7, "ropes"), (8, "sails")], shop.CATEGORIES)
    got = jobs.elite_top_category(orders, items, variants, products, categories, min_categories=2, top_n=1)
    assert shop.tuples(got) == [(8, "sails", 2)]
    none = jobs.elite_top_category(orders, items, variants, products, categories, min_categories=3)
    assert shop.tuples(none) == []
