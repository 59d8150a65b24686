"""Every registered query against its SQL oracle on the smallest tables."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)




@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    problem = compare(spark, con, name, SF_DIR, entry.queries()[name], ORACLES.get(name))
    assert problem is None, problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "n_messages" in df.columns
