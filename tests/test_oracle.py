"""Every registered query against its SQL oracle, on whole tables."""

import os

import pytest

import __spark_entry__ as driver
from oracle_check import differences, duck
from tradewind.workload.oracle import ORACLE
from tradewind.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= driver.queries().items() and ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    ours = QUERIES[name](spark, SF_DIR).toArrow()
    theirs = con.sql(ORACLE[name]).to_arrow_table()
    assert ours.num_rows > 0
    assert differences(ours, theirs) == []


def test_entry(spark):
    assert driver.entry(spark).count() == 10
