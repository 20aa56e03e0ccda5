"""Every registered query with SQL agrees with DuckDB on whole tables."""

import pytest

import __spark_entry__ as entry
from bloomline.plans import catalog
from compare import check, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


CHECKED = set(catalog.QUERIES) | set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CHECKED))
def test_query(spark, con, name):
    assert check(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name)) == "ok"


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_stable(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() == second.count() > 0
