import pytest

from spindrel.operators import comparison, knowledge


def types(spark, *rows):
    return spark.createDataFrame(rows, "type_key string, parent string")


def test_deep_hierarchies(spark):
    rows = [(f"t{i}", f"t{i - 1}" if i else None) for i in range(20)] + [("alone", None), ("stray", "missing"), ("under", "stray")]
    got = {r["type_key"]: (r["root"], r["depth"]) for r in knowledge.ancestors(types(spark, *rows)).collect()}
    assert got == {f"t{i}": ("t0", i) for i in range(20)} | {"alone": ("alone", 0), "stray": ("stray", 0), "under": ("stray", 1)}


@pytest.mark.parametrize("rows", [[("a", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", None)]])
def test_cycles_fail(spark, rows):
    with pytest.raises(ValueError, match="cycle"):
        knowledge.ancestors(types(spark, *rows))


def test_components_that_are_not_done_fail(spark):
    nodes = spark.createDataFrame([(f"n{i:02}",) for i in range(40)], "node string")
    edges = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}") for i in range(39)], "a string, b string")
    assert {r["component"] for r in comparison.components(nodes, edges).collect()} == {"n00"}
    with pytest.raises(RuntimeError, match="after 1 rounds"):
        comparison.components(nodes, edges, most_rounds=1)
