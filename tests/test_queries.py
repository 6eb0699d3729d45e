"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from layerhouse.plans.catalogue import QUERIES, SQL
from compare import SF, duck, duck_rows, spark_rows

EMPTY = {"grain_check", "orphan_fk_check", "scd2_one_current_check"}


@pytest.fixture(scope="module")
def con():
    return duck()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    want_names, want = duck_rows(con, SQL[name])
    assert names == want_names
    assert len(rows) == len(want)
    assert rows == want
    assert bool(rows) == (name not in EMPTY)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
