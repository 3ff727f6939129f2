import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrel.operators import embedding


def points(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in r]) for i, r in enumerate(x)], "id bigint, vec array<double>")


def test_components(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5)) * [5, 3, 1, 0.5, 0.1]
    scores, shares = embedding.components(points(spark, x), 2)
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(shares, (s**2 / (s**2).sum())[:2])
    got = np.array([r["pc"] for r in scores.orderBy("id").collect()])
    want = c @ vt[:2].T
    assert np.allclose(np.abs(got), np.abs(want))
    assert embedding.components(points(spark, x).limit(0), 2)[1] == []


@pytest.mark.parametrize("block", [3, 4096])
def test_nearest(spark, block):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(80, 3)), 1)  # ties and repeated points
    p = points(spark, x).repartition(5)
    got = {(r["query"], r["rank"]): r["id"] for r in embedding.nearest(p, p.where("id % 9 = 0"), 6, block).collect()}
    want = {}
    for q in range(0, 80, 9):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(80), d)) if i != q][:6]
        want |= {(q, k + 1): i for k, i in enumerate(order)}
    assert got == want
    assert embedding.nearest(p, p.limit(0), 3).count() == 0 and embedding.nearest(p.limit(0), p.where("id = 0"), 3).count() == 0


def test_silhouette(spark):
    x = np.array([[0, 0], [0, 1], [9, 9], [9, 8], [50, 50.0]])
    p = points(spark, x).withColumn("label", F.element_at(F.array(F.lit("a"), F.lit("a"), F.lit("b"), F.lit("b"), F.lit("c")), (F.col("id") + 1).cast("int")))
    got = {r["id"]: r["silhouette"] for r in embedding.silhouette(p).collect()}
    b = (np.hypot(9, 9) + np.hypot(9, 8)) / 2
    assert got[0] == pytest.approx((b - 1) / b) and got[4] == 0.0 and len(got) == 5


def test_search_parameter():
    calls = []
    count = lambda r: calls.append(r) or int(10 * r)
    at, k = embedding.search_parameter(count, 17, 0.1, 5.0)
    assert abs(k - 17) <= 1 and int(10 * at) == k and len(calls) <= 20
    assert embedding.search_parameter(lambda r: 3, 50, 0, 1)[1] == 3


def test_grid_has_every_combination(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(20, 2)), rng.normal(size=(20, 2)) + 30])
    p = points(spark, x)
    rows = embedding.grid_search(p, embedding.nearest(p, p, 5), [2, 5], [2])
    assert [(r["n_neighbors"], r["rounds"]) for r in rows] == [(2, 2), (5, 2)] and all(r["n_clusters"] >= 2 and -1 <= r["silhouette"] <= 1 for r in rows)
