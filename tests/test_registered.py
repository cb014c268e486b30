"""Every registered query runs; those with SQL give the same rows."""

import pytest

from suite import registry
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(registry.CHECKS))
def test_same_rows(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
