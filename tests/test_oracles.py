import pytest

from tests.compare import assert_same, database
from tidemark.plans import catalogue

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert_same(catalogue.QUERIES[name](spark, SMALL), connection, catalogue.ORACLES[name])


def test_entry_has_rows_and_all_names(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
