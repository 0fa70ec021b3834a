import pytest
from oracle import connect, same

from waymill.plans import catalogue

QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, sf_dir, con, name):
    same(QUERIES[name](spark, sf_dir), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_gives_the_same_rows_twice(spark, sf_dir, name):
    once, again = (sorted(map(str, QUERIES[name](spark, sf_dir).collect())) for _ in range(2))
    assert once and once == again


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
