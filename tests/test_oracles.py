"""Every registered query against its oracle on the driver's smallest tables."""

import re

import pytest

import __spark_entry__ as contract
from palimpsest.workload.registry import ORACLES, QUERIES
from tests.compare import compare, oracle_connection
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert all(name in ORACLES for name in QUERIES if name != "pipeline" and not name.startswith("op"))


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_oracle(spark, connection, name):
    rows = contract.queries()[name](spark, SF)
    assert not re.search("BatchEvalPython|CartesianProduct|BroadcastNestedLoopJoin", plan_of(rows))
    assert compare(spark, SF, name, lambda *_: rows, contract.oracle_sql()[name], connection) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
