"""Bulk samples: size factors, flags, correlation, distances, and a negative-binomial test of two conditions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.operators.stats import benjamini_hochberg, correlation


def v() -> Column:
    return F.col("value").cast("double")


def size_factors(x: DataFrame) -> DataFrame:
    """Median of ratios: each sample against the geometric means of the genes that all samples have above zero."""
    n = x.select("sample").distinct().count()
    logs = x.where("value > 0").withColumn("l", F.ln(v()))
    ref = logs.groupBy("gene").agg(F.avg("l").alias("g"), F.count(F.lit(1)).alias("k")).where(F.col("k") == n)
    return logs.join(ref, "gene").groupBy("sample").agg(F.exp(F.median(F.col("l") - F.col("g"))).alias("size_factor"))


def sample_flags(x: DataFrame, least_total: float, least_genes: int) -> DataFrame:
    per = x.groupBy("sample").agg(F.sum(v()).alias("total"), F.count_if(F.col("value") > 0).alias("n_genes"))
    return per.withColumn("low_quality", (F.col("total") < least_total) | (F.col("n_genes") < least_genes))


def expressed_genes(x: DataFrame, least_total: float) -> DataFrame:
    return x.groupBy("gene").agg(F.sum(v()).alias("total")).where(F.col("total") >= least_total)


def sample_correlation(x: DataFrame, genes: int) -> DataFrame:
    """Pearson correlation of ``log1p`` values of every pair of samples over all ``genes``, absent values being 0."""
    log = x.select("sample", "gene", F.log1p(v()).alias("v"))
    own = log.groupBy("sample").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
    a, b = log.select(F.col("sample").alias("a"), "gene", F.col("v").alias("va")), log.select(F.col("sample").alias("b"), "gene", F.col("v").alias("vb"))
    dot = a.join(b, "gene").where("a < b").groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"))
    side = lambda t: own.select(F.col("sample").alias(t), F.col("s").alias(f"s{t}"), F.col("q").alias(f"q{t}"))
    cov = F.col("dot") - F.col("sa") * F.col("sb") / genes
    spread = F.sqrt((F.col("qa") - F.col("sa") * F.col("sa") / genes) * (F.col("qb") - F.col("sb") * F.col("sb") / genes))
    distance = F.sqrt(F.greatest(F.lit(0.0), F.col("qa") + F.col("qb") - 2 * F.col("dot")))
    return dot.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.try_divide(cov, F.when(spread > 0, spread)).alias("r"), distance.alias("distance"))


def batch_aligned(x: DataFrame, batches: DataFrame) -> DataFrame:
    """Each gene's mean and spread within a batch moved to those over all samples."""
    joined = x.join(batches, "sample")
    g, b = Window.partitionBy("gene"), Window.partitionBy("gene", "batch")
    sd = lambda w: F.coalesce(F.stddev_pop(v()).over(w), F.lit(0.0))
    scaled = F.when(sd(b) > 0, (v() - F.avg(v()).over(b)) / F.when(sd(b) > 0, sd(b))).otherwise(0.0)
    return joined.withColumn("aligned", scaled * sd(g) + F.avg(v()).over(g))


def _wald(own: pd.DataFrame) -> pd.DataFrame:
    """Two-group negative-binomial fit by reweighted least squares, dispersion by moments within the conditions."""
    y, f, t = own["value"].to_numpy(float), own["size_factor"].to_numpy(float), own["treated"].to_numpy(float)
    q = y / f
    mean = q.mean()
    level = np.where(t > 0, q[t > 0].mean() if (t > 0).any() else 0.0, q[t <= 0].mean() if (t <= 0).any() else 0.0)
    spread = ((q - level) ** 2).sum() / max(len(q) - 2, 1)
    alpha = max((spread - (level / f).mean()) / (level**2).mean(), 1e-8) if len(q) > 2 and mean > 0 else 1e-8
    design = np.c_[np.ones_like(t), t]
    beta = np.array([math.log(max(mean, 1e-8)), 0.0])
    info = np.eye(2)
    for _ in range(50):
        mu = np.maximum(f * np.exp(np.clip(design @ beta, -30, 30)), 1e-8)
        w = mu / (1 + alpha * mu)
        info = design.T @ (design * w[:, None]) + 1e-6 * np.eye(2)
        new = np.linalg.solve(info, design.T @ (w * (np.log(mu / f) + (y - mu) / mu)))
        if np.abs(new - beta).max() < 1e-8:
            beta = new
            break
        beta = new
    se = math.sqrt(np.linalg.inv(info)[1, 1])
    z = beta[1] / se
    return pd.DataFrame({"gene": [own["gene"].iat[0]], "log2fc": [beta[1] / math.log(2)], "z": [z], "p": [math.erfc(abs(z) / math.sqrt(2))]})


def two_condition_test(x: DataFrame, samples: DataFrame, treated: str, control: str) -> DataFrame:
    """Wald test of each gene between two conditions; ``samples(sample, condition)``. A gene's group has a row for each sample."""
    chosen = samples.where(F.col("condition").isin(treated, control)).join(size_factors(x), "sample")
    chosen = chosen.select("sample", "size_factor", (F.col("condition") == treated).cast("double").alias("treated"))
    genes = x.select("gene").distinct()
    full = genes.crossJoin(F.broadcast(chosen)).join(x.select("sample", "gene", F.bround(v()).alias("value")), ["sample", "gene"], "left").na.fill(0.0, ["value"])
    fits = full.groupBy("gene").applyInPandas(_wald, "gene string, log2fc double, z double, p double")
    return benjamini_hochberg(fits, "p")


def rank_metric(p_adj: str, log_fc: str):  # noqa: ANN201
    """Signed significance for ranking genes; null where either is."""
    return -F.log10(F.greatest(F.col(p_adj), F.lit(1e-300))) * F.signum(log_fc)


__all__ = ["batch_aligned", "correlation", "expressed_genes", "rank_metric", "sample_correlation", "sample_flags", "size_factors", "two_condition_test"]
