"""Every registered query against its reference SQL on the smallest data."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect
from reviewloom.catalog.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, e in REGISTRY.items() if e.sql))
def test_matches_reference_sql(spark, con, name):
    entry = REGISTRY[name]
    assert compare(spark, con, FOLDER, entry.run, entry.sql) is None


@pytest.mark.parametrize("name", sorted(n for n, e in REGISTRY.items() if not e.sql))
def test_runs(spark, name):
    assert REGISTRY[name].run(spark, FOLDER).count() > 0


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"category", "nb_reviews", "avg_rating"}
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
