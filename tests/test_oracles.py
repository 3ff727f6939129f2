"""Every query outside the llm subpackage against its SQL on the smallest tables."""

import importlib

import __spark_entry__ as entry
import compare
import pytest
from conftest import DATA

MODULES = [importlib.import_module(m) for m in entry._PLANS]
QUERIES = {k: f for m in MODULES for k, f in m.queries().items()}
SQL = {k: s for m in MODULES for k, s in m.oracle_sql().items()}


#: Queries that SQL cannot express, and the test that holds them to another version or to what must be true of them.
TESTED = {
    "marker_table": "test_stats.test_marker_table", "redundant_pathways": "test_stats.test_redundant_pathways",
    "bulk_two_conditions": "test_stats.test_two_conditions", "differential_accessibility": "test_sampling.test_accessibility_background",
    "principal_components": "test_embedding.test_components", "neighbour_grid": "test_embedding.test_grid_has_every_combination",
}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(DATA)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_queries_without_sql_have_a_test():
    assert set(TESTED) == set(QUERIES) - set(SQL)
    for place in TESTED.values():
        module, _, name = place.partition(".")
        assert callable(getattr(importlib.import_module(module), name))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    said = compare.compare(spark, duck, DATA, name, SQL.get(name))
    assert said.startswith("ok" if name in SQL else "rows"), said
    assert name in SQL or not said.startswith("rows 0 "), said


def test_entry(spark):
    assert entry.entry(spark).count() > 0
