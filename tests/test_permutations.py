import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrel.operators import permutations, registry


def moments(stat, n, items):
    got = np.array([stat(p) for p in itertools.permutations(items)]) if n <= 7 else None
    return got.mean(axis=0), got.std(axis=0)


EDGES = [(0, 1), (1, 2), (2, 3), (3, 4), (4, 0), (1, 4), (5, 6), (4, 5)]


def both_ways(spark, schema="src int, dst int"):
    return spark.createDataFrame([*EDGES, *[(b, a) for a, b in EDGES]], schema)


def test_contacts_against_all_permutations(spark):
    labels = ["a", "a", "b", "b", "b", "c", "a"]
    count = lambda ls: [sum({ls[x], ls[y]} == {p, q} for x, y in EDGES) for p, q in itertools.combinations_with_replacement("abc", 2)]
    mean, sd = moments(count, 7, labels)
    out = permutations.contact_enrichment(both_ways(spark), spark.createDataFrame(list(enumerate(labels)), "id int, label string")).orderBy("a", "b").collect()
    assert [r["n"] for r in out] == count(labels)
    assert [r["expected"] for r in out] == pytest.approx(list(mean))
    for r, m, s in zip(out, mean, sd, strict=True):
        assert r["z"] is None if s < 1e-9 else r["z"] == pytest.approx((r["n"] - m) / s)


def test_moran_against_all_permutations(spark):
    x = [1.0, 5.0, 2.5, -3.0, 0.5, 9.0, 2.0]

    def moran(v):
        z = np.array(v) - np.mean(v)
        return [len(v) / (2 * len(EDGES)) * 2 * sum(z[a] * z[b] for a, b in EDGES) / (z @ z)]

    mean, sd = moments(moran, 7, x)
    values = spark.createDataFrame([(i, "f", v) for i, v in enumerate(x)], "id int, feature string, v double")
    r = permutations.moran_test(values, both_ways(spark).withColumn("w", F.lit(1.0))).first()
    assert r["moran"] == pytest.approx(moran(x)[0]) and r["expected"] == pytest.approx(mean[0]) and r["z"] == pytest.approx((moran(x)[0] - mean[0]) / sd[0])


def test_interactions_against_all_permutations(spark):
    ligand, receptor, labels = [1.0, 0.0, 2.0, 0.0, 5.0, 1.0, 0.0], [0.0, 3.0, 1.0, 0.0, 0.0, 2.0, 1.0], ["a", "a", "a", "b", "b", "b", "b"]
    pairs = list(itertools.product("ab", repeat=2))
    mean_of = lambda v, ls, g: np.mean([x for x, y in zip(v, ls, strict=True) if y == g])
    stat = lambda ls: [(mean_of(ligand, ls, s) + mean_of(receptor, ls, t)) / 2 for s, t in pairs]
    mean, sd = moments(stat, 7, labels)
    x = spark.createDataFrame([(i, g, v) for g, col in (("L", ligand), ("R", receptor)) for i, v in enumerate(col) if v], "cell_id int, gene string, value double")
    out = permutations.interaction_test(x, spark.createDataFrame(list(enumerate(labels)), "cell_id int, grp string"), spark.createDataFrame([("L", "R")], "ligand string, receptor string"))
    got = {(r["source"], r["target"]): r for r in out.collect()}
    for k, m, s, now in zip(pairs, mean, sd, stat(labels), strict=True):
        assert got[k]["lr_mean"] == pytest.approx(now) and got[k]["z"] == pytest.approx((now - m) / s)


def test_write_back_and_patches(spark):
    cells = spark.createDataFrame([(1, "x", "old"), (2, "y", "old"), (3, None, "old")], "id int, c string, label string")
    dec = spark.createDataFrame([("x", "new", "why")], "c string, label string, note string")
    got = {r["id"]: (r["label"], r["note"]) for r in registry.written_back(cells, dec, "c", ["label", "note"]).collect()}
    assert got == {1: ("new", "why"), 2: ("old", None), 3: ("old", None)}
    none = spark.createDataFrame([], "cluster string, old string, new string, n int")
    assert {r["label"] for r in registry.patched(cells, none, "c", "label").collect()} == {"old"}
