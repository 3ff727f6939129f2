import itertools
from collections import defaultdict

import __spark_entry__ as entry
import duckdb
import pyarrow as pa
import pytest
from conftest import DATA

from spindrel.operators import comparison


def test_top_sets(spark):
    rows = [("many", f"g{i:02}", float(i)) for i in range(20)] + [("low", f"g{i:02}", 0.1) for i in range(17)] + [("two", "a", 99.0), ("two", "b", 98.0), ("two", "a", 97.0)]
    rows += [("again", g, s) for g, s in (("a", 1.0), ("a", 9.0), ("b", 2.0), ("c", -3.0))]
    got = defaultdict(set)
    for cluster, gene in comparison.top_sets(spark.createDataFrame(rows, "cluster string, gene string, score double")).collect():
        got[cluster].add(gene)
    assert got == {"many": {f"g{i:02}" for i in range(5, 20)}, "low": {f"g{i:02}" for i in range(15)}, "again": {"a", "b", "c"}}


def test_cosine_pairs_are_the_edges(spark):
    sets = spark.createDataFrame([(f"c{i}", f"g{i * k % 23}") for i in range(1, 30) for k in range(1, 6)], "cluster string, gene string")
    v = comparison.idf_vectors(sets).cache()
    pairs = lambda df: {(r["a"], r["b"]): round(r["cosine"], 9) for r in df.collect()}
    assert pairs(comparison.cosine_pairs(v, 0.1)) == pairs(comparison.cosine_edges(v, 0.1)) != {}


def test_clusters_of_low_scores_are_kept(spark):
    real = "dataset_id is not null and group_label is not null and names is not null and scores is not null and not isnan(scores)"
    sizes = duckdb.sql(f"select dataset_id || '|' || group_label, least(15, count(distinct upper(names))), max(scores) from '{DATA}/marker_gene.parquet' where {real} group by 1 having count(distinct upper(names)) >= 3").fetchall()
    assert any(top <= 15 for *_, top in sizes)
    got = {r["cluster"]: r["count"] for r in entry.queries()["gene_set_vectors"](spark, DATA).groupBy("cluster").count().collect()}
    assert got == {cluster: n for cluster, n, _ in sizes}
    assert {r["node"] for r in entry.queries()["cluster_communities"](spark, DATA).collect()} == set(got)


def shuffled(spark, work):
    """What ``work`` returns, and the bytes that it writes to shuffle files."""
    sc = spark.sparkContext._jsc.sc()

    def so_far():
        sc.listenerBus().waitUntilEmpty(30_000)
        every = sc.statusStore().executorList(False)
        return sum(every.apply(k).totalShuffleWrite() for k in range(every.size()))

    before = so_far()
    return work(), so_far() - before


def test_pairs_of_clusters_are_not_shuffled(spark):
    own = {f"c{i:04}": {f"g{i % 40 + k}": (1 + k) / 60**0.5 for k in range(5)} | {"all": (5 / 60) ** 0.5} for i in range(1200)}
    vectors = spark.createDataFrame([(c, g, w) for c, genes in own.items() for g, w in genes.items()], "cluster string, gene string, w double")
    got, size = shuffled(spark, lambda: {(r["a"], r["b"]): r["cosine"] for r in comparison.cosine_edges(vectors, 0.25).collect()})
    dots = {(a, b): sum(w * own[b].get(g, 0.0) for g, w in own[a].items()) for a, b in itertools.combinations(own, 2)}
    assert got == pytest.approx({k: d for k, d in dots.items() if d >= 0.25}) and 4000 < len(got) < len(dots) == 719_400
    assert size < 240_000, size  # 339,103 when pairs were shuffled


@pytest.mark.parametrize("most", [1, 7, 10_000])
@pytest.mark.parametrize("apart", [False, True])
def test_block_edges_of_any_portion(apart, most):
    own = [(f"c{i}", [f"g{i * k % 11}" for k in range(1, 5)], [1.0 * k for k in range(1, 5)]) for i in range(1, 21)]
    blocks = (own[:12], own[12:]) if apart else (own, own)
    kind = pa.list_(pa.struct({"cluster": pa.string(), "genes": pa.list_(pa.string()), "ws": pa.list_(pa.float64())}))
    low, high = (pa.array([[{"cluster": c, "genes": g, "ws": w} for c, g, w in x]], kind) for x in blocks)
    pair = pa.record_batch({"own_low": pa.array([0]), "low": low, "own_high": pa.array([int(apart)]), "high": high})
    found = [r for part in comparison._block_edges(pair, 5.0, most) for r in part.to_pylist()]
    dot = lambda x, y: sum(v * w for g, v in zip(*x[1:], strict=True) for h, w in zip(*y[1:], strict=True) if g == h)
    pairs = itertools.product(*blocks) if apart else itertools.combinations(own, 2)
    due = {(x[0], y[0]): d for x, y in pairs if (d := dot(x, y)) >= 5.0}
    assert len(found) == len(due) > 0 and {(r["a"], r["b"]): r["cosine"] for r in found} == pytest.approx(due)


def test_edges_within_a_part_are_not_shuffled(spark):
    edges = [(f"{part}{i:03}", f"{part}{k:03}") for part in "xy" for i, k in itertools.combinations(range(300), 2)]
    nodes = spark.createDataFrame([(x,) for x in sorted({*itertools.chain(*edges), "z"})], "node string")
    table = spark.createDataFrame(edges[::2] + [(b, a) for a, b in edges[1::2]], "a string, b string")
    got, size = shuffled(spark, lambda: {r["node"]: r["component"] for r in comparison.components(nodes, table).collect()})
    assert got == {r["node"]: "z" if r["node"] == "z" else r["node"][0] + "000" for r in nodes.collect()}
    assert size < 3 * len(edges), size
