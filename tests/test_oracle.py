"""Every registered query against its SQL, value by value."""

import pytest

import __spark_entry__ as entry_point
import oracle_queries
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(entry_point.shop_queries()) == set(oracle_queries.statements())


@pytest.mark.parametrize("name", sorted(entry_point.shop_queries()))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, name) == []
