"""Every query of the workload against its checking SQL, on whole tables; tests/llm checks the others."""

import pytest

import __spark_entry__ as contract
from workload.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLE)


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:3] == ["REGISTRY_ID", "PGM_SYS_ACRNM", "PGM_SYS_ID"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    problem = difference(spark, duck, SF_DIR, QUERIES[name], ORACLE[name])
    assert problem is None, problem
