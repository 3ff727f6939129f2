import pytest
from pyspark.sql import functions as F

from spindrel.functions.text import label_key
from spindrel.operators import annotation as A


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_noise(spark):
    genes = ["MT-CO1", "RPL3", "MRPS2", "LINC01", "C1orf2", "AC0123", "SOX2", "RP1", "MTOR"]
    got = frame(spark, [(g,) for g in genes], "gene string").where(~A.is_noise(F.col("gene"))).collect()
    assert [r[0] for r in got] == ["SOX2", "RP1", "MTOR"]


def test_low_quality(spark):
    rows = [("mt", f"MT-{i}", 9.0) for i in range(3)] + [("ribo", f"RPL{i}", 9.0) for i in range(5)] + [("mix", f"MT-{i}", 9.0) for i in range(2)]
    rows += [("mix", f"RPS{i}", 8.0) for i in range(4)] + [("good", f"G{i}", 1.0) for i in range(30)] + [("good", "MT-1", None), ("good", "MT-2", 0.0), ("good", "MT-3", 0.0)]
    got = {r["cluster"]: r["reason"] for r in A.low_quality(frame(spark, rows, "cluster string, gene string, logfc double")).collect()}
    assert got == {"mt": "mito_high", "ribo": "ribo_high", "mix": "mito_ribo_mixed", "good": None}


def test_scores(spark):
    kb = frame(spark, [("a", f"A{i}", 3) for i in range(6)] + [("b", f"B{i}", 1) for i in range(6)] + [("c", "C0", 1)], "type string, gene string, n_sources int")
    m = frame(spark, [("x", f"A{i}", 9.0 - i) for i in range(4)] + [("x", "B0", 1.0), ("x", "RPL1", 10.0), ("y", "Z", 1.0)], "cluster string, gene string, logfc double")
    neg = frame(spark, [("a", "B0"), ("a", "A3")], "type string, gene string")
    got = {(r["cluster"], r["type"]): r for r in A.score_clusters(m, kb, neg).collect()}
    assert set(got) == {("x", "a"), ("x", "b")}
    a, b = got["x", "a"], got["x", "b"]
    # 4 hits of high support count 8, which is more than the 6 markers, so they count as they are: P(X >= 4), 6 of 13 marked, 5 drawn
    assert a["method"] == "hypergeometric" and a["p"] == pytest.approx((15 * 7 + 6) / 1287, rel=1e-9) and a["penalty"] and a["consensus"] == "high"
    assert a["score"] == pytest.approx((1 - a["p"]) / 2) and a["evidence"] == "window_padding" or a["window"] == 20
    assert b["hits"] == 1 and b["score"] < 1


def test_transitions(spark):
    s = frame(spark, [(c, t, v) for c in "xyz" for t, v in (("a", 0.5), ("b", 0.45), ("c", 0.2))] + [("w", "a", 0.9), ("w", "b", 0.3)], "cluster string, type string, score double")
    parents = frame(spark, [("a", "p"), ("b", "p"), ("c", "q")], "type string, parent string")
    kb = frame(spark, [("a", "G1"), ("b", "G1"), ("a", "P"), ("b", "P"), ("p", "P")], "type string, gene string")
    none = frame(spark, [], "a string, b string")
    got = lambda k, f: sorted(tuple(r) for r in A.transitions(s, parents, k, f).collect())
    assert got(kb, none) == [(c, "a", "b") for c in "xyz"]
    assert got(kb, frame(spark, [("b", "a")], "a string, b string")) == []
    assert got(kb.where("gene = 'P'"), none) == []  # only what the parent has


def test_tiers(spark):
    s = frame(spark, [("x", "M", 0.9), ("x", "M1", 0.85), ("x", "M2", 0.88), ("y", "M", 0.9), ("y", "M1", 0.5), ("z", "N", 0.4)], "cluster string, type string, score double")
    parents = frame(spark, [("M1", "M"), ("M2", "M")], "type string, parent string")
    m = frame(spark, [(c, g) for c in "xyz" for g in ("P1", "P2")], "cluster string, gene string")
    private = frame(spark, [("M1", "P1", 2), ("M2", "P2", 1)], "type string, gene string, n_sources int")
    got = {r["cluster"]: tuple(r)[1:] for r in A.tiered(s, parents, m, private).collect()}
    assert got == {"x": ("M1", "L3", "resolved"), "y": ("M", "L2", "unresolved"), "z": ("N", "L2", "na")}


def test_retry_needs_three_clusters(spark):
    hits = lambda *r: frame(spark, list(r), "cluster string, hits long")
    three = frame(spark, [("x",), ("y",), ("z",)], "cluster string")
    got = lambda c: {r["cluster"]: (r["hits"], r["retried"]) for r in A.retried(hits(("x", 2)), hits(("x", 9), ("y", 3)), c).collect()}
    assert got(three) == {"x": (2, False), "y": (3, True), "z": (0, False)}
    assert got(three.where("cluster < 'z'")) == {"x": (2, False), "y": (0, False)}


def test_label_key(spark):
    given = ["Müller  Glia!", "hémo-X", "ŠĆ ł", "__a__", ""]
    got = [r[0] for r in frame(spark, [(g,) for g in given], "l string").select(label_key(F.col("l"))).collect()]
    assert got == ["muller_glia", "hemo_x", "sc", "a", ""]


def test_empty_tables(spark):
    m, k = frame(spark, [], "cluster string, gene string, logfc double"), frame(spark, [], "type string, gene string, n_sources int")
    assert A.score_clusters(m, k).count() == 0 and A.windows(m, k).count() == 0 and A.top_consensus(k).count() == 0
    assert A.quality_report(m, F.lit(True)).first()["pass_rate"] == 0.0
