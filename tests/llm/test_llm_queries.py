"""Queries of the llm subpackage against their SQL on the smallest tables."""

from pathlib import Path

import compare
import pytest
from conftest import DATA

from spindrel.llm import queries as plans

SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(DATA)


#: Queries that SQL cannot express, and the test that holds them to another version or to what must be true of them.
TESTED = {
    "p1_found": "test_canonical.test_rows", "p1_unmatched": "test_canonical.test_values", "p5_sample": "test_cube.test_counts_are_met_and_limits_kept",
    "p6_containers": "test_packing.test_pack", "p6_report": "test_packing.test_bounds_shape_the_containers", "p7_found": "test_leaks.test_against_brute_force",
    "p7_passages": "test_leaks.test_recall_of_changed_passages", "p8_found": "test_prose.test_mixtures_get_their_share", "p8_statistics": "test_prose.test_statistics",
}


def test_queries_without_sql_have_a_test():
    assert set(TESTED) == set(plans.queries()) - set(SQL)
    for place in TESTED.values():
        module, _, name = place.partition(".")
        assert f"def {name}(" in (Path(__file__).parent / f"{module}.py").read_text()


@pytest.mark.parametrize("name", plans.queries())
def test_query(spark, duck, name):
    said = compare.compare(spark, duck, DATA, name, SQL.get(name))
    assert said.startswith("ok" if name in SQL else "rows"), said
    assert not said.startswith("rows 0 "), said


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("p1_found", {"row_id", "type_key"}), ("p3_found", {"dataset_id", "group_label", "names"}), ("p5_found", {"setting_id", "grp"}),
        ("p7_found", {"doc_id", "item_id"}), ("p8_found", {"doc_id"}),
    ],
)
def test_columns(spark, name, columns):
    assert set(plans.queries()[name](spark, DATA).columns) == columns
