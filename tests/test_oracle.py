"""Every query against its SQL counterpart, over whole tables."""

import re
from pathlib import Path

import pytest
from compare import DATA, differences, duck

import __spark_entry__ as contract
from workload.oracles import SQL
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(f"{DATA}/sf0.001")


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, con):
    df = contract.queries()[name](spark, f"{DATA}/sf0.001")
    assert not differences(df, contract.oracle_sql()[name], con)


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 24 and df.count() == 5013


def test_no_test_imports_conftest():
    """Two folders have one; which of them an import finds depends on the order of collection."""
    here = Path(__file__).parent
    for file in here.rglob("test_*.py"):
        assert not re.search(r"^\s*(from|import) conftest\b", file.read_text(), re.M), file
