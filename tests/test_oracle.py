"""Every registered query against its SQL on the smallest data set."""

import pytest

from checks.compare import connect, spark_rows, sql_rows
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    if name in ORACLES:
        want_names, want = sql_rows(con, ORACLES[name])
        assert names == want_names
        assert rows == want
    else:
        assert rows


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 20
    assert set(entry.oracle_sql()) <= set(entry.queries())
