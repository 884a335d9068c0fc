import pytest

import __spark_entry__ as contract
import compare

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir="/root/testdata/sf0.001"):
    return compare.connect(small_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    if name in SQL:
        assert compare.difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 20
