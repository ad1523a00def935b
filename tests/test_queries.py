import pytest
from compare import assert_same

from polyweave.plans import catalogue, library  # noqa: F401


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_gives_what_sql_gives(spark, sf, name):
    assert_same(spark, sf, catalogue.QUERIES[name], catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
