"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

from check import compare, duck
from tallgrass.catalog import QUERIES, TWINS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    outcome = compare(spark, con, FOLDER, name)
    assert outcome.startswith("ok" if name in TWINS else "rows-only"), outcome


def test_the_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.queries().keys() >= entry.oracle_sql().keys()
    assert entry.entry(spark).count() > 0
