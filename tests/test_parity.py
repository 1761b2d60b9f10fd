"""Every registered query against its SQL, and how it is planned."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from parity.compare import connect, differences
from parity.oracle import oracle_sql
from parity.queries import queries
from tests.conftest import SMALL, plan_text


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_result_as_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) == ""


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(queries()) - set(oracle_sql()) == {"dataset_sizes"}


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 5 and df.columns[0] == "region"


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_join_in_any_plan(spark, name):
    plan = plan_text(queries()[name](spark, SMALL))
    for word in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert word not in plan
