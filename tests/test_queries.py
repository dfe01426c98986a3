"""Every registered query against DuckDB on the smallest data set."""

import pytest

from workload.compare import compare, connect
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    status, _, _ = compare(spark, duck, FOLDER, name)
    assert status in ("ok", "rows-only"), status


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
