"""Every registered query against its SQL twin, on whole tables."""

import pytest

import check
from catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    ok, note = check.compare(spark, tables, name, SF)
    assert ok, note


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"year", "issue", "records"}
