"""Random small shops with NULLs, repeated ids and hot keys, against DuckDB on the same rows."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest

import shop
from oracle_check import differences
from tradewind.plans import customers, demand, orders, recommend, sales

VALID = "status IN ('paid', 'confirmed')"
LINES = """
    (SELECT * FROM orders WHERE status IN ('paid', 'confirmed')) o
    JOIN items i ON i.order_id = o.id
    JOIN variants v ON v.id = i.product_variant_id
    JOIN products p ON p.id = v.product_id
"""
TICKETS = f"""
    SELECT customer_id, sum(total) AS revenue, count(DISTINCT id) AS frequency
    FROM orders WHERE {VALID} GROUP BY customer_id
"""
VARIETY = f"SELECT o.customer_id, count(DISTINCT p.category_id) AS category_count FROM {LINES} GROUP BY 1"


def random_shop(spark, seed):
    rng = random.Random(seed)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(300), hours=rng.randrange(24))
    customer = lambda: rng.choice([None, 1, 1, 1, rng.randrange(8), rng.randrange(8)])
    order_rows = [
        (rng.randrange(70), customer(), rng.choice(["paid", "confirmed", "open"]), rng.choice(["pos", "web"]),
         rng.choice([None, Decimal(0), Decimal(rng.randrange(1, 9999)) / 100]), placed, placed)
        for placed in (day() for _ in range(90))]
    item_rows = [(5 if rng.random() < 0.3 else rng.randrange(80), rng.choice([100, 100 + rng.randrange(14)]),
                  rng.choice([None, 1, 2, 7])) for _ in range(250)]
    product_rows = [(p, rng.choice(["rope", "sail", "oar", None]), rng.choice([None, 7, 8, 9])) for p in range(12)]
    product_rows += [(3, "second name", 8)]
    variant_rows = [(100 + n, n) for n in range(12)] + [(100, 0), (112, 1)]
    frames = {
        "orders": spark.createDataFrame(order_rows, shop.ORDERS),
        "items": spark.createDataFrame(item_rows, shop.ITEMS),
        "variants": spark.createDataFrame(variant_rows, shop.VARIANTS),
        "products": spark.createDataFrame(product_rows, shop.PRODUCTS),
        "categories": spark.createDataFrame([(7, "a"), (8, "b"), (8, "b"), (9, None)], shop.CATEGORIES),
    }
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name + "_rows", frame.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
    return frames, con


@pytest.fixture(params=range(4))
def case(spark, request):
    frames, con = random_shop(spark, request.param)
    chain = frames["orders"], frames["items"], frames["variants"], frames["products"]
    return chain, frames, lambda df, sql: differences(df.toArrow(), con.sql(sql).to_arrow_table())


def test_orders(case):
    chain, frames, compare = case
    overview = orders.orders_overview(chain[0]).selectExpr(
        "row_count", "min_date", "CAST(min_total AS DOUBLE) AS min_total", "CAST(max_total AS DOUBLE) AS max_total")
    assert compare(overview, """
        SELECT count(*) AS row_count, min(created_at) AS min_date, CAST(min(total) AS DOUBLE) AS min_total,
               CAST(max(total) AS DOUBLE) AS max_total FROM orders""") == []
    assert compare(orders.order_lines(*chain).select("order_id", "customer_id", "product_id", "quantity"),
                   f"SELECT o.id AS order_id, customer_id, product_id, quantity FROM {LINES}") == []


def test_customers(case):
    chain, frames, compare = case
    metrics = customers.customer_metrics(chain[0]).selectExpr(
        "customer_id", "CAST(revenue AS DOUBLE) AS revenue", "frequency")
    assert compare(metrics, f"SELECT customer_id, CAST(revenue AS DOUBLE) AS revenue, frequency FROM ({TICKETS})") == []
    assert compare(customers.category_diversity(*chain), VARIETY) == []
    ranked = f"""
        SELECT customer_id FROM ({TICKETS}) JOIN ({VARIETY}) USING (customer_id) WHERE category_count >= 2
        ORDER BY revenue / frequency DESC NULLS FIRST, customer_id LIMIT 3"""
    exact = customers.elite_customers(*chain, min_categories=2, top_n=3, round_ticket=False)
    assert compare(exact.select("customer_id"), ranked) == []
    top = customers.elite_top_category(*chain, frames["categories"], min_categories=2, top_n=3)
    assert compare(top, f"""
        SELECT c.id AS category_id, c.name AS category, CAST(sum(i.quantity) AS BIGINT) AS total_quantity
        FROM {LINES} JOIN categories c ON c.id = p.category_id WHERE o.customer_id IN ({ranked})
        GROUP BY 1, 2 ORDER BY 3 DESC NULLS FIRST, 1 LIMIT 1""") == []


def test_sales(case):
    chain, frames, compare = case
    days = sales.calendar_sales(chain[0]).selectExpr("date", "CAST(sales AS DOUBLE) AS sales")
    assert compare(days, f"""
        WITH sold AS (SELECT CAST(placed_at AS DATE) AS date, sum(total) AS amount FROM orders
                      WHERE channel = 'pos' AND {VALID} GROUP BY 1),
        days AS (SELECT CAST(unnest(generate_series(
                     (SELECT min(CAST(placed_at AS DATE)) FROM orders),
                     (SELECT max(CAST(placed_at AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS date)
        SELECT date, CAST(coalesce(amount, 0) AS DOUBLE) AS sales FROM days LEFT JOIN sold USING (date)""") == []


def test_demand(case):
    chain, frames, compare = case
    sold = f"""
        SELECT p.name AS product_name, CAST(date_trunc('month', placed_at) AS DATE) AS month,
               CAST(coalesce(sum(quantity), 0) AS BIGINT) AS sold
        FROM {LINES} WHERE p.name IS NOT NULL GROUP BY 1, 2"""
    dense = f"""
        SELECT product_name, month, coalesce(sold, 0) AS quantity
        FROM (SELECT product_name, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month
              FROM (SELECT product_name, min(month) AS a, max(month) AS b FROM ({sold}) GROUP BY 1))
        LEFT JOIN ({sold}) USING (product_name, month)"""
    assert compare(demand.monthly_demand(*chain), dense) == []
    assert compare(demand.monthly_demand(*chain, product_name="rope"),
                   f"SELECT * FROM ({dense}) WHERE product_name = 'rope'") == []


def test_purchases(case):
    chain, frames, compare = case
    bought = recommend.purchases(*chain)
    assert compare(recommend.purchase_pairs(bought), f"""
        SELECT DISTINCT customer_id, p.id AS product_id, p.name AS product_name FROM {LINES}""") == []
    pairs = f"SELECT DISTINCT customer_id, p.id AS product_id FROM {LINES} WHERE customer_id IS NOT NULL"
    assert compare(recommend.item_cosine(bought, cell=3), f"""
        WITH pairs AS ({pairs}), n AS (SELECT product_id, count(*) AS n FROM pairs GROUP BY 1)
        SELECT a.product_id AS product_a, b.product_id AS product_b,
               round_even(count(*) / sqrt(CAST(x.n * y.n AS DOUBLE)), 4) AS cosine_similarity
        FROM pairs a JOIN pairs b ON a.customer_id = b.customer_id AND a.product_id < b.product_id
        JOIN n x ON x.product_id = a.product_id JOIN n y ON y.product_id = b.product_id
        GROUP BY a.product_id, b.product_id, x.n, y.n""") == []
