"""Every registered query against its SQL, whole results and types."""

import pytest

import __spark_entry__ as entry
from checks.cases import CASES
from checks.compare import compare, duck

ORACLES = entry.oracle_sql()
# The training-data queries have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in CASES}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    problem, _ = compare(spark, con, sf, name, QUERIES[name], ORACLES.get(name))
    assert problem is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(CASES) <= set(ORACLES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["doi_key", "doi", "source", "pos", "status", "path"]
    assert df.count() > 0
