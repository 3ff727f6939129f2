"""Embeddings: components, exact nearest neighbours, votes, label propagation, silhouettes, stability, searches over parameters."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrel.operators.sampling import sample_n
from spindrel.runtime import checkpoint

BLOCK = 4096


def components(points: DataFrame, k: int) -> tuple[DataFrame, list[float]]:
    """``id, pc``: scores on the ``k`` first principal components of ``points(id, vec)``, and their shares of the variance; empty for an empty table.

    The covariance is summed over partitions; only its square matrix of dimensions reaches the driver. Columns are centred, and the
    sign of a component is that of its largest loading.
    """
    one = points.where("vec is not null").select(F.size("vec")).first()
    if one is None:
        return points.select("id", F.array().cast("array<double>").alias("pc")), []
    points, dims = points.where("vec is not null"), one[0]
    mean = points.select(F.array(*[F.avg(F.col("vec")[i].cast("double")) for i in range(dims)]).alias("m"))
    centred = points.crossJoin(F.broadcast(mean)).select("id", F.zip_with("vec", "m", lambda a, b: a.cast("double") - b).alias("c"))
    centred = checkpoint(centred)
    vectors = centred.select("id", array_to_vector("c").alias("c"))
    model = PCA(k=k, inputCol="c", outputCol="pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    scores = model.transform(vectors).select("id", vector_to_array("pc").alias("pc"))
    flip = F.array(*[F.lit(float(s)) for s in signs])
    return scores.select("id", F.zip_with("pc", flip, lambda a, s: a * s).alias("pc")), [float(v) for v in model.explainedVariance.toArray()]


def nearest(points: DataFrame, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``query, id, distance, rank``: the ``k`` nearest of ``points(id, vec)`` to each of ``queries(id, vec)``, itself left out.

    Exact, by Euclidean distance and then id. Queries are sent in blocks of bounded size; each block is one pass over the points,
    in which every batch of rows keeps its ``k`` best of each query.
    """
    out = None
    rows = iter(queries.select("id", "vec").where("vec is not null").orderBy("id").toLocalIterator())
    while part := list(itertools.islice(rows, block)):
        ids, matrix = np.array([r[0] for r in part]), np.array([r[1] for r in part], float)
        sent = points.sparkSession.sparkContext.broadcast((ids, matrix))

        def scan(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            q, m = sent.value
            for b in batches:
                if not len(b):
                    continue
                own, x = b["id"].to_numpy(), np.stack(b["vec"].to_numpy()).astype(float)
                for a in range(0, len(q), 256):
                    d = np.sqrt(np.maximum(((m[a : a + 256, None, :] - x[None, :, :]) ** 2).sum(axis=2), 0.0))
                    d[q[a : a + 256, None] == own[None, :]] = np.inf
                    keep = min(k, len(own))
                    order = np.lexsort((np.broadcast_to(own, d.shape), d), axis=1)[:, :keep]
                    found = np.take_along_axis(d, order, axis=1)
                    one = pd.DataFrame({"query": np.repeat(q[a : a + 256], keep), "id": own[order].ravel(), "distance": found.ravel()})
                    yield one[np.isfinite(one["distance"])]

        found = points.select("id", "vec").where("vec is not null").mapInPandas(scan, "query bigint, id bigint, distance double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return points.sparkSession.createDataFrame([], "query bigint, id bigint, distance double, rank int")
    order = Window.partitionBy("query").orderBy("distance", "id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def transferred(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """``query, label, share``: the commonest label among each query's neighbours, ties by label. ``labels(id, label)``."""
    votes = neighbours.join(labels.select("id", "label"), "id").groupBy("query", "label").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("query").orderBy(F.desc("n"), "label")
    k = votes.withColumn("k", F.row_number().over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("query")))
    return k.where("k = 1").select("query", "label", (F.col("n") / F.col("all")).alias("share"))


def propagated(edges: DataFrame, rounds: int) -> DataFrame:
    """``node, label`` after so many rounds in which each node takes the commonest label of its neighbours, the smallest of equals.

    ``edges(src, dst)`` in both directions; every node begins with itself as its label.
    """
    e = checkpoint(edges.select("src", "dst").distinct())
    now = e.select(F.col("src").alias("node")).distinct().withColumn("label", F.col("node"))
    order = Window.partitionBy("src").orderBy(F.desc("n"), "label")
    for _ in range(rounds):
        n = e.join(now.withColumnRenamed("node", "dst"), "dst").groupBy("src", "label").agg(F.count(F.lit(1)).alias("n"))
        now = checkpoint(n.withColumn("k", F.row_number().over(order)).where("k = 1").select(F.col("src").alias("node"), "label"))
    return now


def group_connections(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between each two groups and their ratio to what the groups' degrees give by chance; ``labels(id, label)``."""
    a, b = (labels.select(F.col("id").alias(c), F.col("label").alias(t)) for c, t in (("src", "a"), ("dst", "b")))
    n = edges.join(a, "src").join(b, "dst").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    deg = n.groupBy("a").agg(F.sum("n").alias("da"))
    total = n.agg(F.sum("n").alias("total"))
    other = n.groupBy("b").agg(F.sum("n").alias("db"))
    j = n.join(deg, "a").join(other, "b").crossJoin(F.broadcast(total)).where("a <> b")
    return j.select("a", "b", "n", (F.col("n") * F.col("total") / (F.col("da") * F.col("db"))).alias("connectivity"))


def silhouette(points: DataFrame, most: int = 10_000, seed: int = 42) -> DataFrame:
    """``id, label, silhouette`` of a sample of at most ``most`` of ``points(id, vec, label)``, within the sample.

    Groups of one have 0. The sample, drawn by hash, is the feature's own bound; it is sent to the tasks.
    """
    chosen = checkpoint(sample_n(points.where("vec is not null and label is not null"), "id", most, seed))
    rows = chosen.orderBy("id").collect()  # at most ``most``
    names = sorted({r["label"] for r in rows})
    code = np.array([names.index(r["label"]) for r in rows], int)
    sent = points.sparkSession.sparkContext.broadcast((np.array([r["vec"] for r in rows], float), code, names))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, group, names_ = sent.value
        size = np.bincount(group, minlength=len(names_))
        for b in batches:
            out = []
            for v, label in zip(b["vec"], b["label"], strict=True):
                d = np.sqrt(((x - np.asarray(v, float)) ** 2).sum(axis=1))
                sums, own = np.bincount(group, d, len(names_)), names_.index(label)
                other = np.delete(sums / size, own)
                a = sums[own] / max(size[own] - 1, 1)
                out.append((other.min() - a) / max(a, other.min()) if size[own] > 1 and len(other) and max(a, other.min()) > 0 else 0.0)
            yield pd.DataFrame({"id": b["id"], "label": b["label"], "silhouette": out})

    kind = dict(points.dtypes)
    return chosen.mapInPandas(measure, f"id {kind['id']}, label {kind['label']}, silhouette double")


def stability(runs: DataFrame) -> DataFrame:
    """``a, b, ari``: adjusted Rand index of every two of a few labellings ``runs(run, id, label)`` of the same rows."""
    r = runs.where("label is not null")
    left, right = r.select("id", F.col("run").alias("a"), F.col("label").alias("la")), r.select("id", F.col("run").alias("b"), F.col("label").alias("lb"))
    cells = left.join(right, "id").where("a < b").groupBy("a", "b", "la", "lb").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = lambda c: c * (c - 1) / 2
    side = lambda c, name: cells.groupBy("a", "b", c).agg(F.sum("n").alias("n")).groupBy("a", "b").agg(F.sum(pairs(F.col("n"))).alias(name))
    both = cells.groupBy("a", "b").agg(F.sum(pairs(F.col("n"))).alias("s"), pairs(F.sum("n")).alias("all"))
    j = both.join(side("la", "sa"), ["a", "b"]).join(side("lb", "sb"), ["a", "b"])
    expected = F.col("sa") * F.col("sb") / F.when(F.col("all") > 0, F.col("all"))
    return j.select("a", "b", F.coalesce(F.try_divide(F.col("s") - expected, (F.col("sa") + F.col("sb")) / 2 - expected), F.lit(1.0)).alias("ari"))


def search_parameter(count: Callable[[float], int], target: int, low: float, high: float, tolerance: int = 1, most_steps: int = 20) -> tuple[float, int]:
    """The parameter whose number of clusters comes nearest to ``target``, by halving the interval; numbers rise with it."""
    best: tuple[int, float, int] | None = None
    for _ in range(most_steps):
        at = (low + high) / 2
        k = count(at)
        if best is None or abs(k - target) < best[0]:
            best = (abs(k - target), at, k)
        if abs(k - target) <= tolerance:
            break
        low, high = (at, high) if k < target else (low, at)
    assert best is not None
    return best[1], best[2]


def grid_search(points: DataFrame, neighbours: DataFrame, sizes: list[int], rounds: list[int], most: int = 10_000) -> list[dict]:
    """One row for each combination: clusters by label propagation on the ``n`` nearest, their number and mean silhouette.

    ``neighbours`` has the largest of ``sizes``; combinations are few, each is a job of its own.
    """
    near = checkpoint(neighbours)
    out = []
    for n, r in itertools.product(sizes, rounds):
        one = near.where(F.col("rank") <= n).select(F.col("query").alias("src"), F.col("id").alias("dst"))
        labels = propagated(one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), r)
        rows = points.select("id", "vec").join(labels.select(F.col("node").alias("id"), "label"), "id")
        s = silhouette(rows, most).agg(F.avg("silhouette"), F.count_distinct("label")).first()
        out.append({"n_neighbors": n, "rounds": r, "n_clusters": s[1], "silhouette": s[0]})
    return out
