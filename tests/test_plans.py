"""The physical plans have the shape that carries over to a cluster."""

import re

import pytest

from tradewind.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def plan(spark, capsys):
    """The plan of a query, optionally as planned when no table is small enough to broadcast."""

    def explain(name, large=False):
        for key, value in LARGE.items() if large else ():
            spark.conf.set(key, value)
        try:
            capsys.readouterr()
            QUERIES[name](spark, SF_DIR).explain("formatted")
            return capsys.readouterr().out
        finally:
            for key in LARGE:
                spark.conf.unset(key)

    return explain


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(plan, name):
    text = plan(name, large=True)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|MapInPandas", text)


def test_filters_and_columns_reach_the_scan(plan):
    text = plan("elite_customers")
    assert "In(o_orderstatus, [F,O])" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "o_orderdate" not in text and "TakeOrderedAndProject" in text


def test_elite_reads_the_orders_once_and_meets_at_the_customer_once(plan):
    text = plan("elite_customers", large=True)
    assert len(re.findall(r"Arguments: hashpartitioning\(customer_id#\d+L?, \d+\)", text)) == 1
    assert not re.search(r"hashpartitioning\(customer_id#\d+L?, [a-z]", text) and "Expand" not in text
    assert len(re.findall(r"ReadSchema: struct<.*o_custkey", text)) == 1


def test_counted_joins_do_not_shuffle_the_lines(plan):
    for name in ("elite_top_category", "product_lines"):
        text = plan(name, large=True)
        assert "BroadcastHashJoin" in text


def test_distinct_counts_spread_a_hot_customer(plan):
    assert re.search(r"hashpartitioning\(customer_id#\d+L, id#\d+L", plan("customer_metrics"))


def test_groups_are_limited_before_the_shuffle(plan):
    assert "WindowGroupLimit" in plan("similar_products_all")


def test_basket_cells_are_their_own_shuffle(plan):
    assert re.search(r"hashpartitioning\(customer_id#\d+L, r#\d+L, c#\d+L, \d+\), REPARTITION_BY_NUM",
                     plan("item_cosine"))


def test_two_distinct_counts_do_not_double_the_pairs(plan):
    assert "Expand" not in plan("matrix_shape")
