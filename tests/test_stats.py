import math
from math import comb

import numpy as np
import pandas as pd
import pytest
from conftest import DATA

import __spark_entry__ as entry
from spindrel.operators import bulk, network, stats
from spindrel.plans import roles


def exact(hits, marked, drawn, total):
    ways = sum(comb(marked, i) * comb(total - marked, drawn - i) for i in range(max(hits, drawn + marked - total, 0), min(marked, drawn) + 1))
    return ways / comb(total, drawn) if hits > 0 else 1.0


CASES = [
    (3, 10, 20, 100), (0, 5, 5, 50), (6, 5, 9, 40), (2, 30, 35, 40), (40, 900, 150, 2001), (170, 700, 900, 4000), (1, 13000, 20, 13299), (60, 400, 1500, 13299),
    (1, 2500, 2500, 5000), (1300, 2500, 2500, 5000),
]


def test_hypergeometric_tail(spark):
    df = spark.createDataFrame([*CASES, (None, 1, 1, 3)], "hits int, marked int, drawn int, total int")
    got = df.select("*", stats.hypergeometric_tail("hits", "marked", "drawn", "total").alias("p")).collect()
    for r in got:
        assert r["p"] is None if r["hits"] is None else r["p"] == pytest.approx(exact(*r[:4]), rel=1e-8, abs=1e-300)


def test_tail_in_parts():
    for case in CASES:
        assert stats._tail(*case, at_once=3) == pytest.approx(stats._tail(*case), rel=1e-9, abs=1e-300)


def test_overrepresentation_of_large_data_sets(spark, tmp_path):
    rows = [("big", "a" if i < 300 else "b", f"g{i}", 30.0 if i % 10 == 0 or i < 60 else 1.0) for i in range(2500)] + [("small", "a", f"g{i}", 30.0 * (i < 3)) for i in range(9)]
    spark.createDataFrame(rows, "dataset_id string, group_label string, names string, scores double").write.parquet(f"{tmp_path}/marker_gene.parquet")
    got = {(r["dataset_id"], r["group_label"]): r for r in entry.queries()["overrepresentation"](spark, str(tmp_path)).collect()}
    assert {k: tuple(r)[2:6] for k, r in got.items()} == {("big", "a"): (84, 300, 304, 2500), ("big", "b"): (220, 2200, 304, 2500), ("small", "a"): (3, 9, 3, 9)}
    for r in got.values():
        assert r["p"] == pytest.approx(exact(*r[2:6]), abs=1e-7)


def adjusted(p):
    order = np.argsort(p, kind="stable")
    q = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    out = np.empty(len(p))
    out[order] = np.minimum(q, 1)
    return out


def test_marker_table(spark):
    """P-values, for which SQL has no normal tail, from dense ranks."""
    x, cells = roles.counts(spark, DATA).toPandas(), roles.cells(spark, DATA).select("cell_id", "cluster").toPandas()
    dense = x.pivot(index="cell_id", columns="gene_id", values="value").reindex(cells["cell_id"]).fillna(0.0).astype(float)
    total = dense.sum(axis=1).replace(0, 1)
    logs, group = np.log1p(dense.div(total, axis=0) * 1e4), cells["cluster"].to_numpy()
    got = entry.queries()["marker_table"](spark, DATA).toPandas().set_index(["grp", "gene_id"])
    n_all = len(logs)
    for grp in sorted(set(group)):
        own, p = group == grp, []
        for gene in logs.columns:
            ranks, n = logs[gene].rank().to_numpy(), own.sum()
            ties = logs[gene].round(12).value_counts().to_numpy().astype(float)
            sigma = math.sqrt((1 - (ties**3 - ties).sum() / (n_all**3 - n_all)) * n * (n_all - n) * (n_all + 1) / 12)
            z = (ranks[own].sum() - n * (n_all + 1) / 2) / sigma
            assert got.loc[(grp, gene), "score"] == pytest.approx(z, abs=1e-6)
            p.append(math.erfc(abs(z) / math.sqrt(2)))
        assert got.loc[[(grp, g) for g in logs.columns], "p"].to_numpy() == pytest.approx(np.array(p), abs=1e-9)
        assert got.loc[[(grp, g) for g in logs.columns], "p_adj"].to_numpy() == pytest.approx(adjusted(np.array(p)), abs=1e-8)


def test_redundant_pathways(spark):
    rows = [("k", "t1", 0.01, ["a", "b", "c"]), ("k", "t2", 0.02, ["a", "b", "c", "d"]), ("k", "t3", 0.03, ["x", "y"]), ("k", "t0", 0.02, ["b", "c", "d", "e"]), ("k", "e1", 0.5, []), ("k", "e2", 0.6, None), ("m", "t2", 0.9, ["a", "b", "c"])]
    df = spark.createDataFrame(rows, "kind string, term string, p_adj double, genes array<string>")
    got = {(r["kind"], r["term"]): r["leader"] for r in network.redundant_terms(df, "kind").collect()}
    # t0 before t2 at equal p: it shares 2 of 5 genes with t1 and leads; t2 is nearer to t1, which comes first.
    assert got == {("k", "t1"): "t1", ("k", "t0"): "t0", ("k", "t2"): "t1", ("k", "t3"): "t3", ("k", "e1"): "e1", ("k", "e2"): "e2", ("m", "t2"): "t2"}


def test_two_conditions(spark):
    rng = np.random.default_rng(1)
    rows = [(f"s{i}", f"g{g}", float(rng.poisson(100 * (4 if g == 0 and i < 4 else 1)))) for i in range(8) for g in range(20)]
    samples = spark.createDataFrame([(f"s{i}", "t" if i < 4 else "c") for i in range(8)], "sample string, condition string")
    got = bulk.two_condition_test(spark.createDataFrame(rows, "sample string, gene string, value double"), samples, "t", "c").toPandas().set_index("gene")
    assert got.loc["g0", "log2fc"] == pytest.approx(2, abs=0.25) and got.loc["g0", "p_adj"] < 1e-6
    assert got.drop("g0")["log2fc"].abs().max() < 0.5 and (got.drop("g0")["p"] < 0.05).sum() <= 4
    assert got["p"].to_numpy() == pytest.approx([math.erfc(abs(z) / math.sqrt(2)) for z in got["z"]])
    assert got["p_adj"].to_numpy() == pytest.approx(adjusted(got["p"].to_numpy())) and isinstance(got, pd.DataFrame)
