"""Every registered query against its SQL, on the smallest data set."""

import pytest
from compare import compare, connect

from shoplens.plans import all_oracles, all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(all_queries()))
def test_same_rows_as_sql(spark, con, name):
    ok, note = compare(spark, con, name, all_queries()[name], all_oracles().get(name), SF)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:2] == ["user_id", "product_id"]
    assert df.count() > 0
