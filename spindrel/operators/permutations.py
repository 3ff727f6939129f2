"""Tests against shuffled labels, by the exact moments of all permutations in place of a sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def v() -> Column:
    return F.col("value").cast("double")


def contact_enrichment(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``a, b, n, expected, z`` (``a <= b``): edges between labels against all ways to hand the labels out anew.

    ``edges(src, dst)`` has each edge both ways, ``labels(id, label)`` every node once. The variance counts pairs of edges that share a node
    and pairs that do not. ``z`` is null where nothing can vary.
    """
    once = edges.where(F.col("src") < F.col("dst")).select("src", "dst").distinct()
    la, lb = labels.select(F.col("id").alias("src"), F.col("label").alias("x")), labels.select(F.col("id").alias("dst"), F.col("label").alias("y"))
    seen = once.join(la, "src").join(lb, "dst").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).cast("double").alias("m"))
    degree = once.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).cast("double").alias("d"))
    graph = degree.agg((F.sum("d") / 2).alias("e"), (F.sum(F.col("d") * (F.col("d") - 1)) / 2).alias("c2")).crossJoin(labels.agg(F.count(F.lit(1)).cast("double").alias("t")))
    pairs = sizes.select(F.col("label").alias("a"), F.col("m").alias("na")).crossJoin(sizes.select(F.col("label").alias("b"), F.col("m").alias("nb"))).where("a <= b")  # few labels
    j = pairs.join(seen, ["a", "b"], "left").na.fill(0, ["n"]).crossJoin(F.broadcast(graph))
    same = F.col("a") == F.col("b")
    n2, n3, n4 = (F.expr(e) for e in ("t * (t - 1)", "t * (t - 1) * (t - 2)", "t * (t - 1) * (t - 2) * (t - 3)"))
    over = lambda top, bottom: F.coalesce(F.try_divide(top, bottom), F.lit(0.0))
    p1 = over(F.when(same, F.expr("na * (na - 1)")).otherwise(F.expr("2 * na * nb")), n2)
    p2 = over(F.when(same, F.expr("na * (na - 1) * (na - 2)")).otherwise(F.expr("na * nb * (na + nb - 2)")), n3)
    p3 = over(F.when(same, F.expr("na * (na - 1) * (na - 2) * (na - 3)")).otherwise(F.expr("4 * na * (na - 1) * nb * (nb - 1)")), n4)
    j = j.withColumns({"expected": F.col("e") * p1, "p1": p1, "p2": p2, "p3": p3})
    variance = F.expr("e * p1 + 2 * c2 * p2 + 2 * (e * (e - 1) / 2 - c2) * p3 - expected * expected")
    return j.select("a", "b", "n", "expected", ((F.col("n") - F.col("expected")) / F.sqrt(F.when(variance > 1e-9, variance))).alias("z"))


def moran_test(values: DataFrame, edges: DataFrame) -> DataFrame:
    """``feature, moran, expected, z`` under all permutations of the values; ``values(id, feature, v)``, ``edges(src, dst, w)`` both ways."""
    n = values.groupBy("feature").agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg("v").alias("mean"))
    z = values.join(n.select("feature", "mean"), "feature").select("id", "feature", (F.col("v") - F.col("mean")).alias("z"))
    own = z.groupBy("feature").agg(F.sum(F.pow("z", F.lit(2))).alias("m2"), F.sum(F.pow("z", F.lit(4))).alias("m4"))
    a, b = z.select(F.col("id").alias("src"), "feature", F.col("z").alias("za")), z.select(F.col("id").alias("dst"), "feature", F.col("z").alias("zb"))
    cross = edges.join(a, "src").join(b, ["dst", "feature"]).groupBy("feature").agg(F.sum(F.col("w") * F.col("za") * F.col("zb")).alias("num"))
    back = edges.select(F.col("src").alias("dst"), F.col("dst").alias("src"), F.col("w").alias("wb"))
    s1 = edges.join(back, ["src", "dst"], "left").agg(F.sum("w").alias("s0"), (F.sum(F.pow(F.col("w") + F.coalesce("wb", F.lit(0.0)), F.lit(2))) / 2).alias("s1"))
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("o")).join(edges.groupBy(F.col("dst").alias("id")).agg(F.sum("w").alias("i")), "id", "full").na.fill(0.0)
    s2 = degree.agg(F.sum(F.pow(F.col("o") + F.col("i"), F.lit(2))).alias("s2"))
    j = n.join(own, "feature").join(cross, "feature").crossJoin(F.broadcast(s1)).crossJoin(F.broadcast(s2)).withColumn("k", F.expr("n * m4 / (m2 * m2)"))
    j = j.withColumn("moran", F.expr("try_divide(n * num, s0 * m2)")).withColumn("expected", F.expr("-1 / (n - 1)"))
    square = F.expr("(n * ((n * n - 3 * n + 3) * s1 - n * s2 + 3 * s0 * s0) - k * ((n * n - n) * s1 - 2 * n * s2 + 6 * s0 * s0)) / ((n - 1) * (n - 2) * (n - 3) * s0 * s0)")
    variance = square - F.col("expected") * F.col("expected")
    return j.select("feature", "moran", "expected", ((F.col("moran") - F.col("expected")) / F.sqrt(F.when(variance > 0, variance))).alias("z"))


def interaction_test(x: DataFrame, labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """``ligand, receptor, source, target, lr_mean, z``: the mean of two groups' means against all ways to hand the labels out anew.

    ``x(cell_id, gene, value)`` without zeros, ``labels(cell_id, grp)`` with every cell, ``pairs(ligand, receptor)``. Means of a group
    vary like those of a sample without replacement, and two groups' like those of disjoint samples.
    """
    cells = labels.agg(F.count(F.lit(1)).cast("double").alias("t"))
    sizes = labels.groupBy("grp").agg(F.count(F.lit(1)).cast("double").alias("n"))
    used = pairs.select(F.explode(F.array("ligand", "receptor")).alias("gene")).distinct()
    own = x.join(used, "gene").join(labels, "cell_id")
    per = own.groupBy("grp", "gene").agg(F.sum(v()).alias("s"))
    whole = own.groupBy("gene").agg(F.sum(v()).alias("s"), F.sum(v() * v()).alias("q"))
    left = pairs.join(own.select("cell_id", F.col("gene").alias("ligand"), v().alias("vl")), "ligand")
    dots = left.join(own.select("cell_id", F.col("gene").alias("receptor"), v().alias("vr")), ["receptor", "cell_id"]).groupBy("ligand", "receptor").agg(F.sum(F.col("vl") * F.col("vr")).alias("dot"))
    gene = lambda name, tag: whole.select(F.col("gene").alias(name), F.col("s").alias(f"s{tag}"), F.col("q").alias(f"q{tag}"))
    base = pairs.join(gene("ligand", "l"), "ligand").join(gene("receptor", "r"), "receptor").join(dots, ["ligand", "receptor"], "left").na.fill(0.0, ["dot"]).crossJoin(F.broadcast(cells))
    side = lambda tag: sizes.select(F.col("grp").alias(tag), F.col("n").alias(f"n_{tag}"))
    mean = lambda name, tag: per.select(F.col("gene").alias(name), F.col("grp").alias(tag), F.col("s").alias(f"own_{tag}"))
    j = base.crossJoin(side("source")).crossJoin(side("target"))  # the result's own rows
    j = j.join(mean("ligand", "source"), ["ligand", "source"], "left").join(mean("receptor", "target"), ["receptor", "target"], "left").na.fill(0.0, ["own_source", "own_target"])
    j = j.withColumns({
        "vl": F.expr("(ql - sl * sl / t) / (t - 1)"), "vr": F.expr("(qr - sr * sr / t) / (t - 1)"), "c": F.expr("(dot - sl * sr / t) / (t - 1)"),
        "lr_mean": F.expr("(own_source / n_source + own_target / n_target) / 2"), "expected": F.expr("(sl / t + sr / t) / 2"),
    })
    cov = F.when(F.col("source") == F.col("target"), F.expr("c / n_source * (1 - n_source / t)")).otherwise(F.expr("-c / t"))
    variance = (F.expr("vl / n_source * (1 - n_source / t) + vr / n_target * (1 - n_target / t)") + 2 * cov) / 4
    return j.select("ligand", "receptor", "source", "target", "lr_mean", ((F.col("lr_mean") - F.col("expected")) / F.sqrt(F.when(variance > 1e-15, variance))).alias("z"))
