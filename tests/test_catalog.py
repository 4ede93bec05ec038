"""Every registered query of the address and road operators against its SQL, on whole tables."""

from __future__ import annotations

import pytest
from compare import duck_rows, spark_rows

from waymark.plans import catalog


def test_all_have_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_as_sql(spark, sf_dir, name):
    assert spark_rows(catalog.QUERIES[name](spark, sf_dir)) == duck_rows(catalog.ORACLES[name], sf_dir)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
