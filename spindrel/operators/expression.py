"""Differential expression: groups against the rest, stages, trends, peaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.operators import matrix, sampling, stats
from spindrel.runtime import checkpoint


def v() -> Column:
    return F.col("value").cast("double")


def rank_genes(x: DataFrame, labels: DataFrame) -> DataFrame:
    """Markers of each group: ``score`` (rank-sum z), ``p``, ``p_adj``, ``logfc`` and shares of cells in and out of the group.

    ``x`` holds ``log1p`` values. The fold change compares means on the linear scale.
    """
    t = stats.group_sums(x, labels)
    rest = F.when(F.col("n_all") > F.col("n"), F.col("n_all") - F.col("n"))
    m1, m2 = F.col("s") / F.col("n"), F.coalesce((F.col("s_all") - F.col("s")) / rest, F.lit(0.0))
    out = t.select(
        "grp", "gene_id", F.col("z").alias("score"), F.log2((F.expm1(m1) + 1e-9) / (F.expm1(m2) + 1e-9)).alias("logfc"),
        (F.col("m") / F.col("n")).alias("pct_in"), F.coalesce((F.col("nnz") - F.col("m")) / rest, F.lit(0.0)).alias("pct_out"),
        stats.normal_two_sided("z").alias("p"),
    )
    return stats.benjamini_hochberg(out, "p", "grp")


def specific(markers: DataFrame, least_in: float = 0.4, most_out: float = 0.3, least_logfc: float = 1.0) -> DataFrame:
    """Markers that many cells of the group and few others have."""
    return markers.where((F.col("pct_in") >= least_in) & (F.col("pct_out") <= most_out) & (F.col("logfc") >= least_logfc))


def adjacent_pairs(stages: DataFrame, stage: str, order: str) -> DataFrame:
    """Consecutive stages in their order: ``first``, ``second``."""
    w = Window.orderBy(order)
    return stages.select(F.col(stage).alias("first"), F.lead(stage).over(w).alias("second")).where("second is not null")


def stage_trends(x: DataFrame, obs: DataFrame, least_cells: int = 50, least_per_stage: int = 5, least_stages: int = 3) -> DataFrame:
    """Rank correlation of a gene's mean (zeros included) with the stage, within each type.

    ``obs(cell_id, type, stage)`` with numeric stages. Types with few cells or stages are left out.
    """
    sizes = obs.groupBy("type", "stage").agg(F.count(F.lit(1)).alias("n"))
    usable = sizes.where(F.col("n") >= least_per_stage)
    per_type = Window.partitionBy("type")
    usable = usable.withColumn("__k", F.count(F.lit(1)).over(per_type)).withColumn("__n", F.sum("n").over(per_type))
    usable = usable.where((F.col("__k") >= least_stages) & (F.col("__n") >= least_cells)).select("type", "stage", "n")
    sums = x.join(obs, "cell_id").groupBy("type", "gene_id", "stage").agg(F.sum(v()).alias("s"))
    genes = sums.select("type", "gene_id").distinct()
    means = genes.join(usable, "type").join(sums, ["type", "gene_id", "stage"], "left").withColumn("mean", F.coalesce("s", F.lit(0.0)) / F.col("n"))
    return stats.spearman(means, "mean", "stage", "type", "gene_id")


def compare_groups(means: DataFrame, group: str, pseudo: float = 1e-9) -> DataFrame:
    """All pairs of conditions in their order: fold change of the second over the first and its log2.

    ``means(<group>, condition, metric)``. The pairs are as many as the conditions allow, which are few.
    """
    a = means.select(group, F.col("condition").alias("first"), F.col("metric").alias("m1"))
    b = means.select(group, F.col("condition").alias("second"), F.col("metric").alias("m2"))
    ratio = (F.col("m2") + pseudo) / (F.col("m1") + pseudo)
    return a.join(b, group).where(F.col("first") < F.col("second")).select(group, "first", "second", "m1", "m2", ratio.alias("fold"), F.log2(ratio).alias("log2_fold"))


def detect_sex(x: DataFrame, cells: DataFrame, female: list[str], male: list[str]) -> DataFrame:
    """Label of each cell by which of two gene sets it expresses."""
    seen = x.where("value > 0").groupBy("cell_id").agg(
        F.coalesce(F.bool_or(F.col("gene_id").isin(female)), F.lit(False)).alias("f"),
        F.coalesce(F.bool_or(F.col("gene_id").isin(male)), F.lit(False)).alias("m"),
    )
    f, m = F.coalesce("f", F.lit(False)), F.coalesce("m", F.lit(False))
    label = F.when(f & m, "Ambiguous").when(f, "Female").when(m, "Male").otherwise("Unknown")
    return cells.join(seen, "cell_id", "left").select("cell_id", label.alias("sex"))


def differential_accessibility(peaks: DataFrame, labels: DataFrame, bins: int = 5, background: int = 200, seed: int = 42) -> DataFrame:
    """Fold change of each peak in each group against a background drawn evenly from bins of sequencing depth.

    Values are ``log1p`` of counts per ten thousand on both sides. The background of a group are at most
    ``background / bins`` cells of every depth bin outside it, the first by a hash of the cell. Each group offers that many of
    each bin, so that a group's background is among what the others offer, and no cell is copied for each group.
    """
    labels = labels.where("grp is not null")
    depth = checkpoint(peaks.groupBy("cell_id").agg(F.sum(v()).alias("depth")).join(labels, "cell_id"))
    cuts = stats.quantiles(depth, "depth", [i / bins for i in range(1, bins)])
    bin_ = sum((F.when(F.col("depth") > c, 1).otherwise(0) for c in cuts if c is not None), F.lit(0))
    share = F.lit(background // bins)
    offered = checkpoint(sampling.per_stratum(depth.withColumn("bin", bin_), "cell_id", ["bin", "grp"], share, seed))  # few rows
    groups = labels.select(F.col("grp").alias("target")).distinct()
    others = offered.join(F.broadcast(groups), F.col("grp") != F.col("target"))
    drawn = sampling.per_stratum(others, "cell_id", ["target", "bin"], share, seed).select("target", "cell_id")
    norm = matrix.normalise(peaks)
    side = lambda cells, by: cells.groupBy(by).agg(F.count(F.lit(1)).alias("n")).join(
        norm.join(cells, "cell_id").groupBy(by, "gene_id").agg(F.sum(v()).alias("s")), by
    ).select(F.col(by).alias("grp"), "gene_id", (F.col("s") / F.col("n")).alias("mean"))
    inside = side(labels, "grp").withColumnRenamed("mean", "mean_in")
    outside = side(drawn, "target").withColumnRenamed("mean", "mean_out")
    both = inside.join(outside, ["grp", "gene_id"], "full").na.fill(0.0)
    return both.withColumn("log2fc", F.log2((F.expm1("mean_in") + 1e-9) / (F.expm1("mean_out") + 1e-9)))
