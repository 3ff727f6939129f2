"""Choosing among clusterings: scores of grid points, frontiers and gates. A grid has few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from spindrel.operators.stats import midrank


def whole() -> WindowSpec:
    return Window.partitionBy()


def splitting_gain(grid: DataFrame) -> DataFrame:
    """New clusters per step of resolution within a neighbourhood size; never below 0, null for the first."""
    w = Window.partitionBy("n_neighbors").orderBy("resolution")
    dk = F.col("n_clusters") - F.lag("n_clusters").over(w)
    dr = F.col("resolution") - F.lag("resolution").over(w)
    return grid.withColumn("splitting_gain", F.greatest(F.lit(0.0), dk / F.when(dr > 0, dr)))


def coherence(scores: DataFrame, sizes: DataFrame, dominance: float = 2.5, floor: float = 0.0, least: int = 10) -> DataFrame:
    """Share of clusters of at least ``least`` cells whose best type stands out ``dominance`` times over the second.

    ``scores(cluster, type, score)`` are means; a single type stands out if it is above the floor.
    """
    w = Window.partitionBy("cluster").orderBy(F.desc("score"), "type")
    two = scores.withColumn("k", F.row_number().over(w)).where("k <= 2").groupBy("cluster").agg(
        F.max(F.when(F.col("k") == 1, F.col("score"))).alias("a"), F.max(F.when(F.col("k") == 2, F.col("score"))).alias("b")
    )
    good = (F.col("a") > floor) & (F.col("b").isNull() | (F.col("b") <= 0) | (F.col("a") / F.when(F.col("b") > 0, F.col("b")) > dominance))
    return two.join(sizes.where(F.col("n") >= least), "cluster").agg(F.avg(good.cast("double")).alias("coherence"), F.count(F.lit(1)).alias("n_clusters"))


def composite(grid: DataFrame, weights: dict[str, float], least_range: float = 0.01) -> DataFrame:
    """Weighted sum of rank-normalised metrics; metrics without enough range count for nothing, the weights of the rest are scaled to 1."""
    n = F.count(F.lit(1)).over(whole())
    used = {m: F.coalesce(F.max(m).over(whole()) - F.min(m).over(whole()) >= least_range, F.lit(False)) for m in weights}
    total = sum((F.when(used[m], F.lit(w)).otherwise(0.0) for m, w in weights.items()), F.lit(0.0))
    norm = {m: F.when(n > 1, (midrank(m) - 1) / (n - 1)).otherwise(0.5) for m in weights}
    score = sum((F.when(used[m], norm[m] * w).otherwise(0.0) for m, w in weights.items()), F.lit(0.0))
    return grid.withColumn("composite", F.try_divide(score, total))


def pareto_elbow(grid: DataFrame, k: str = "n_clusters", s: str = "silhouette") -> DataFrame:
    """Points with no other of fewer clusters and a better score; ``distance`` to the ideal corner and the ``chosen`` one."""
    before = Window.orderBy(k, F.desc(s)).rowsBetween(Window.unboundedPreceding, -1)
    front = grid.withColumn("__best", F.max(s).over(before)).where(F.col("__best").isNull() | (F.col(s) > F.col("__best"))).drop("__best")
    scaled = lambda c: (F.col(c) - F.min(c).over(whole())) / (F.max(c).over(whole()) - F.min(c).over(whole()) + 1e-10)
    out = front.withColumn("distance", F.sqrt(F.pow(1 - scaled(s), 2) + F.pow(scaled(k), 2)))
    return out.withColumn("chosen", F.row_number().over(Window.orderBy("distance", k)) == 1)


def granularity(grid: DataFrame, flat: float = 0.05, few: int = 10) -> DataFrame:
    """``subtype`` if scores hardly vary and there are few clusters, else ``major``; from the middle neighbourhood size."""
    sizes = grid.select("n_neighbors").distinct()
    middle = sizes.agg(F.sort_array(F.collect_set("n_neighbors")).alias("a"))
    middle = middle.select(F.element_at("a", (F.size("a") / 2).cast("int") + 1).alias("n_neighbors"))
    own = grid.join(F.broadcast(middle), "n_neighbors")
    cv = F.try_divide(F.stddev_pop("silhouette"), F.abs(F.avg("silhouette")))
    return own.agg(cv.alias("cv"), F.max("n_clusters").alias("max_k")).withColumn(
        "granularity", F.when((F.col("cv") < flat) & (F.col("max_k") < few), "subtype").otherwise("major")
    )


def gated(grid: DataFrame, genes: str = "min_de", least: int = 25) -> DataFrame:
    """The most clusters that all have enough marker genes, else the point with the most such genes."""
    order = Window.orderBy(F.desc((F.col(genes) >= least).cast("int")), F.desc(F.when(F.col(genes) >= least, F.col("n_clusters")).otherwise(F.col(genes))), "resolution", "n_neighbors")
    return grid.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")
