"""Every registered query against its SQL twin; queries without one must return rows."""

import pytest
from check import compare, connect

from docsift.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    equal, note = compare(spark, con, sf, name)
    assert equal is not False, note
    if equal is None:
        assert not note.startswith("0 rows")


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
