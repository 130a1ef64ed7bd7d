import re

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare, connect
from tests.conftest import DATA

# The queries of the llm subpackage have their own tests.
SECTIONS = sorted(set(contract.queries()) - set(contract.LLM_QUERIES))


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_contract_names_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(SECTIONS) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).columns == [
        "user_id", "evenements", "retours_1j", "delai_max_j"]


@pytest.mark.parametrize("name", SECTIONS)
def test_query_equals_its_sql(spark, con, name):
    frame = contract.queries()[name](spark, DATA)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert compare(frame, con.sql(sql)) == "OK"


def test_oracles_read_the_given_tables():
    for name, sql in contract.oracle_sql().items():
        assert any(re.search(rf"\b{t}\b", sql) for t in TABLES), name
    assert duckdb.__version__
