"""Pathways, regulons, ligands and receptors: relevance to known markers, filters, expansions."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pathway_relevance(pathways: DataFrame, markers: list[str]) -> DataFrame:
    """Common genes of each pathway with the markers, their share, and significance times one plus the share.

    ``pathways(term, p_adj, genes ARRAY)``. Without markers all overlaps are 0.
    """
    known = F.array(*[F.lit(m) for m in markers]).cast("array<string>")
    n = F.size("genes")
    hits = F.filter("genes", lambda g: F.array_contains(known, g))
    ratio = F.when(n > 0, F.size(hits) / F.when(n > 0, n)).otherwise(0.0)
    out = pathways.withColumn("overlap", F.size(hits)).withColumn("ratio", ratio)
    return out.withColumn("relevance", -F.log10(F.greatest("p_adj", F.lit(1e-300))) * (1 + F.col("ratio")))


def tissue_filter(pathways: DataFrame, allow: list[str], deny: list[str]) -> DataFrame:
    """Verdict on each pathway: allowed and denied words decide, the rest by a scaled score above the median of the undecided."""
    has = lambda words: F.exists(F.array(*[F.lit(w.lower()) for w in words]).cast("array<string>"), lambda w: F.contains(F.lower("term"), w))
    everything = Window.partitionBy()
    span = F.max("relevance").over(everything) - F.min("relevance").over(everything)
    scaled = F.when(span > 0, (F.col("relevance") - F.min("relevance").over(everything)) / F.when(span > 0, span)).otherwise(0.0)
    out = pathways.withColumn("__scaled", scaled).withColumn("__open", ~has(allow) & ~has(deny))
    median = out.where("__open").agg(F.median("__scaled").alias("__median"))
    score = F.when(has(allow), 1.0).when(has(deny), -1.0).when(F.col("__scaled") > F.col("__median"), F.col("__scaled")).otherwise(0.0)
    return out.crossJoin(F.broadcast(median)).withColumn("tissue_score", score).withColumn("kept", score > 0).drop("__scaled", "__open", "__median")


def redundant_terms(pathways: DataFrame, by: str, similarity: float = 0.6) -> DataFrame:
    """Greedy leaders: terms by rising p-value join the first earlier leader with a Jaccard similarity of at least ``similarity``.

    One after the other by nature; each group in ``by`` is one task's work and holds the terms of one test.
    """
    schema = f"{by} {dict(pathways.dtypes)[by]}, term string, leader string"

    def lead(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["p_adj", "term"], kind="stable")
        leaders: list[tuple[str, set]] = []
        out = []
        for term, genes in zip(own["term"], own["genes"], strict=True):
            mine = set(genes if genes is not None else [])
            found = next((t for t, g in leaders if (mine or g) and len(mine & g) / len(mine | g) >= similarity), None)
            if found is None:
                leaders.append((term, mine))
            out.append(found or term)
        return pd.DataFrame({by: own[by], "term": own["term"], "leader": out})

    return pathways.select(by, "term", "p_adj", "genes").groupBy(by).applyInPandas(lead, schema)


def regulons(net: DataFrame, least: int = 5) -> DataFrame:
    """Edges of sources with at least ``least`` distinct targets."""
    wide = net.groupBy("source").agg(F.countDistinct("target").alias("n")).where(F.col("n") >= least)
    return net.join(wide, "source", "left_semi")


def activity(expression: DataFrame, net: DataFrame) -> DataFrame:
    """Activity of each source in each group: t of the slope of expression on edge weight over all genes of the groups.

    ``expression(grp, gene, mean)`` holds all genes of a group; genes without an edge weigh 0.
    """
    weights = net.groupBy("source", F.col("target").alias("gene")).agg(F.sum("weight").alias("w"))
    y = F.col("mean").cast("double")
    groups = expression.groupBy("grp").agg(F.count(y).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"))
    # Genes without an edge add nothing to the sums of weights, so only edges are joined.
    held = expression.select("grp", "gene", y.alias("y")).join(weights, "gene").groupBy("grp", "source").agg(
        F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("w")).alias("sww"), F.sum(F.col("w") * F.col("y")).alias("swy")
    )
    sources = net.select("source").distinct()
    t = groups.crossJoin(sources).join(held, ["grp", "source"], "left").na.fill(0.0, ["sw", "sww", "swy"])  # one row of the result each
    spread = F.expr("(n * sww - sw * sw) * (n * syy - sy * sy)")
    r = F.expr("n * swy - sw * sy") / F.sqrt(F.when(spread > 0, spread))
    t = t.select("grp", "source", "n", r.alias("r"))
    unexplained = 1 - F.col("r") * F.col("r")
    return t.select("grp", "source", "r", "n", F.when(F.col("n") > 2, F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, F.when(unexplained > 0, unexplained)))).alias("t"))


def source_relevance(activities: DataFrame, net: DataFrame, markers: list[str]) -> DataFrame:
    """Mean absolute activity times one plus the share of marker genes among the targets, upper case compared."""
    known = [m.upper() for m in markers]
    share = net.groupBy("source").agg(F.avg(F.upper("target").isin(known).cast("double")).alias("ratio"))
    mean = activities.groupBy("source").agg(F.avg(F.abs("t")).alias("activity"), F.var_samp("t").alias("variance"))
    return mean.join(share, "source").withColumn("relevance", F.col("activity") * (1 + F.col("ratio")))


def adjacency_matches(pairs: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Kind of contact of each ``source, target``; the pair as given wins over the reversed one. Letter case does not count."""
    kinds = adjacency.groupBy(F.lower("source").alias("s"), F.lower("target").alias("t")).agg(F.min("kind").alias("kind"))
    forward = kinds.select(F.col("s").alias("__s"), F.col("t").alias("__t"), F.col("kind").alias("__f"))
    backward = kinds.select(F.col("t").alias("__s"), F.col("s").alias("__t"), F.col("kind").alias("__b"))
    p = pairs.withColumn("__s", F.lower("source")).withColumn("__t", F.lower("target"))
    out = p.join(forward, ["__s", "__t"], "left").join(backward, ["__s", "__t"], "left")
    return out.withColumn("kind", F.coalesce("__f", "__b")).drop("__s", "__t", "__f", "__b")


def interactions(stats_: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every ordered pair of groups with every ligand and receptor that they express.

    ``stats_(grp, gene, mean, prop)``, ``pairs(ligand, receptor)``.
    """
    side = lambda gene, tag: stats_.select(F.col("grp").alias(tag), F.col("gene").alias(gene), F.col("mean").alias(f"mean_{tag}"), F.col("prop").alias(f"prop_{tag}"))
    out = pairs.join(side("ligand", "source"), "ligand").join(side("receptor", "target"), "receptor")
    return out.withColumn("lr_mean", (F.col("mean_source") + F.col("mean_target")) / 2).withColumn("lr_prod", F.col("mean_source") * F.col("mean_target"))


def enrichment_score(ranked: DataFrame, group: list[str], member: Column) -> DataFrame:
    """Running-sum score of a gene set in a ranking by falling ``metric``, hits weighted by its size."""
    w = Window.partitionBy(*group).orderBy(F.desc("metric"), "gene").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    hit = F.when(member, F.abs("metric")).otherwise(0.0)
    miss = (~member).cast("double")
    part = lambda v: F.sum(v).over(w) / F.when(F.sum(v).over(whole) > 0, F.sum(v).over(whole))
    run = ranked.withColumn("__run", F.coalesce(part(hit), F.lit(0.0)) - F.coalesce(part(miss), F.lit(0.0)))
    top = F.max("__run"), F.min("__run")
    return run.groupBy(*group).agg(F.when(top[0] >= -top[1], top[0]).otherwise(top[1]).alias("es"), F.sum(member.cast("int")).alias("n_hits"))
