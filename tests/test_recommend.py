import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import shop
from tradewind.operators.overlap import shared_customers
from tradewind.plans import recommend as jobs

SCHEMA = "customer_id int, product_id int, product_name string"


def bought(spark, rows):
    return spark.createDataFrame([(c, p, f"product {p}") for c, p in rows], SCHEMA)


def products(spark, ids):
    return spark.createDataFrame([(p, f"product {p}", 1) for p in ids], shop.PRODUCTS)


def brute_force(rows):
    """Dense cosine matrix as {(a, b): similarity} over all ordered pairs."""
    pairs = {(c, p) for c, p in rows if c is not None}
    customers, items = sorted({c for c, _ in pairs}), sorted({p for _, p in pairs})
    matrix = np.zeros((len(customers), len(items)))
    for c, p in pairs:
        matrix[customers.index(c), items.index(p)] = 1
    shared = matrix.T @ matrix
    norm = np.sqrt(np.outer(np.diag(shared), np.diag(shared)))
    return items, {(a, b): shared[i, j] / norm[i, j] for i, a in enumerate(items)
                   for j, b in enumerate(items) if a != b}


def skewed(seed):
    """A third of all purchases by one customer and a third of one product."""
    rng = random.Random(seed)
    rows = [(rng.randrange(1, 30), rng.randrange(40)) for _ in range(150)]
    rows += [(0, p) for p in range(60)] + [(c, 7) for c in range(30)]
    return rows + [(None, 99), (None, 7)] + rows[:20]


@pytest.mark.parametrize("cell", [1, 2, 3, 7, 512])
def test_cosine_is_exact_for_any_cell_size(spark, cell):
    rows = skewed(cell)
    _, expected = brute_force(rows)
    got = {(r.product_a, r.product_b): r.cosine_similarity
           for r in jobs.item_cosine(bought(spark, rows), cell).collect()}
    related = {(a, b): s for (a, b), s in expected.items() if a < b and s > 0}
    assert got.keys() == related.keys()
    assert all(got[k] == pytest.approx(related[k], abs=5.1e-5) and 0 < got[k] <= 1 for k in got)


def test_hot_customer_is_spread(spark):
    """No cell, hence no key of the shuffle, holds more than a few slices of a hot customer."""
    from tradewind.operators.overlap import _cells, _sliced

    pairs = spark.range(400).select(F.lit(0).alias("customer_id"), F.col("id").alias("product_id"))
    cells = _cells(_sliced(pairs, 20), 8)
    sizes = [len(r.basket) for r in cells.collect()]
    assert len(sizes) == 20 * 21 // 2 and max(sizes) < 100
    assert shared_customers(pairs, 20).count() == 400 * 399 // 2


@pytest.mark.parametrize("top_n", [1, 3, 5, 60])
def test_top_n_of_every_product(spark, top_n):
    rows = skewed(1) + [(1000, 500), (1001, 501)]  # two products without any related product
    items, expected = brute_force(rows)
    got = {}
    for r in jobs.similar_products_all(bought(spark, rows), top_n, cell=5).orderBy("rank").collect():
        got.setdefault(r.product_id, []).append((r.rank, r.similar_id))
    for a in items:
        best = sorted((b for b in items if b != a), key=lambda b: (-round(expected[a, b], 12), b))
        assert got[a] == list(enumerate(best, start=1))[:top_n]


@pytest.mark.parametrize("packed", [0, 10, 1000])
def test_hot_products_are_counted_alike(spark, packed):
    """Whatever products count as hot: none, some or all."""
    rows = skewed(1) + [(1000, 500)]
    items, expected = brute_force(rows)
    pairs = jobs.known_pairs(bought(spark, rows))
    got = {(r.product_a, r.product_b): r.shared / r.norm for r in shared_customers(pairs, 5, packed).collect()}
    assert got == {(a, b): pytest.approx(s) for (a, b), s in expected.items() if a < b and s > 0}
    found = {}
    for r in jobs.similar_products_all(bought(spark, rows), 3, cell=5, packed=packed).orderBy("rank").collect():
        found.setdefault(r.product_id, []).append(r.similar_id)
    assert found == {a: sorted((b for b in items if b != a), key=lambda b: (-round(expected[a, b], 12), b))[:3] for a in items}


@pytest.mark.parametrize("both", [False, True])
def test_pairs_are_shuffled_as_arrays_only(spark, both):
    """Counting, and choosing the best of each product, need no shuffle by pair."""
    from tradewind.operators.overlap import shared_by_product

    pairs = jobs.known_pairs(bought(spark, skewed(4)))
    (counted,) = shared_by_product(pairs, both=both)
    plan = (jobs._best_of_each(counted, 5) if both else counted)._jdf.queryExecution().executedPlan().toString()
    last = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "hashpartitioning(product_id" in last and "REPARTITION_BY_NUM" in last and "ids#" in plan


def test_similar_to_a_name(spark):
    rows = skewed(2)
    items, expected = brute_force(rows)
    best = sorted((b for b in items if b != 7), key=lambda b: (-round(expected[7, b], 12), b))[:5]
    got = jobs.similar_products(bought(spark, rows), products(spark, range(100)), "product 7").collect()
    assert [(r.rank, r.product_id, r.product_name) for r in got] == [
        (i, b, f"product {b}") for i, b in enumerate(best, start=1)]
    assert [r.cosine_similarity for r in got] == pytest.approx([expected[7, b] for b in best], abs=5.1e-5)


def test_unrelated_products_fill_up_in_id_order(spark):
    got = jobs.similar_products(
        bought(spark, [(1, 5), (1, 6), (2, 1), (3, 2), (4, 3)]), products(spark, range(10)), "product 5")
    assert [(r.product_id, r.cosine_similarity) for r in got.collect()] == [
        (6, 1.0), (1, 0.0), (2, 0.0), (3, 0.0)]


def test_same_name_takes_the_smallest_id_and_missing_name_is_marked(spark):
    both = spark.createDataFrame([(1, "rope", 1), (2, "rope", 1), (3, None, 1)], shop.PRODUCTS)
    rows = spark.createDataFrame([(1, 2, "rope"), (1, 1, "rope"), (1, 3, None)], SCHEMA)
    got = jobs.similar_products(rows, both, "rope").collect()
    assert [(r.product_id, r.product_name) for r in got] == [(2, "rope"), (3, "?")]


@pytest.mark.parametrize("name", ["product 8", "product 9"])
def test_unknown_or_anonymous_reference(spark, name):
    with pytest.raises(ValueError):
        jobs.similar_products(bought(spark, [(1, 5), (None, 9)]), products(spark, range(10)), name)


def test_score_rounds_half_even(spark):
    """One shared customer of 16 and 64 is 1/32 = 0.03125."""
    rows = [(0, 1), (0, 2)] + [(c, 1) for c in range(1, 16)] + [(c, 2) for c in range(100, 163)]
    assert jobs.item_cosine(bought(spark, rows)).first().cosine_similarity == 0.0312


def test_matrix(spark):
    rows = bought(spark, [(1, 5), (1, 5), (2, 5), (2, 6), (None, 7)])
    assert sorted(shop.tuples(jobs.user_item_matrix(rows))) == [(1, 5, 1), (2, 5, 1), (2, 6, 1)]
    assert tuple(jobs.matrix_shape(rows).first()) == (2, 2)
    assert jobs.purchase_pairs(rows).count() == 4
    assert sorted(shop.tuples(jobs.product_names(rows)))[-1] == (7, "product 7")
