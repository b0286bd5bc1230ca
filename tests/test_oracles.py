"""Every registered query runs; those with a SQL twin must equal it exactly."""

import pytest

from check_oracles import compare, duck
from habitscope.registry import oracle_texts, query_functions

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = query_functions(), oracle_texts()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, connection, key):
    problems = [p for p in compare(QUERIES[key](spark, SF), connection, ORACLES[key]) if p != "no rows"]
    assert problems == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, SF).count() > 0
