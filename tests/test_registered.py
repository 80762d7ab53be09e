"""Every registered query against its SQL twin, or for a schema and rows where there is none."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, folder, name):
    equal, message, _ = compare(spark, con, QUERIES[name], ORACLES[name], folder)
    assert equal, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.count() > 0 and df.columns
