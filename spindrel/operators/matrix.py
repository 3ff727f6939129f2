"""Operators on a sparse matrix in long form, ``x(cell_id, gene_id, value)``: absent pairs are zeros.

Every mean or variance divides by all cells, never by the rows that are there. Sums are taken in double
precision. Nothing is made dense.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def v() -> Column:
    return F.col("value").cast("double")


def cell_metrics(x: DataFrame, mt: Column, ribo: Column, top: int = 20) -> DataFrame:
    """Per cell: stored genes, total, sums and percentages of two gene sets and of the ``top`` largest values.

    Percentages of a cell without counts are null, as is ``complexity`` (log genes over log total) where it
    is no finite number.
    """
    largest = Window.partitionBy("cell_id").orderBy(F.desc("value"), "gene_id")
    ranked = x.withColumn("__rank", F.row_number().over(largest))
    agg = ranked.groupBy("cell_id").agg(
        F.count(F.lit(1)).alias("n_genes"),
        F.sum(v()).alias("total"),
        F.sum(F.when(mt, v()).otherwise(0.0)).alias("mt"),
        F.sum(F.when(ribo, v()).otherwise(0.0)).alias("ribo"),
        F.sum(F.when(F.col("__rank") <= top, v()).otherwise(0.0)).alias("top"),
    )
    share = lambda c: F.try_divide(F.col(c) * 100, "total")
    log_total = F.when(F.col("total") > 1, F.log10("total"))
    return agg.select(
        "cell_id", "n_genes", "total", F.log1p("total").alias("log1p_total"), share("mt").alias("pct_mt"), share("ribo").alias("pct_ribo"),
        share("top").alias("pct_top"), (F.log10("n_genes") / log_total).alias("complexity"),
    )


def gene_metrics(x: DataFrame, n_cells: int | Column) -> DataFrame:
    """Per gene: cells with a value above zero, total, mean over all cells and percentage of dropouts."""
    n = F.lit(n_cells) if isinstance(n_cells, int) else n_cells
    return x.groupBy("gene_id").agg(
        F.count_if(F.col("value") > 0).alias("n_cells"),
        F.sum(v()).alias("total"),
        (F.sum(v()) / F.max(n)).alias("mean"),
        ((1 - F.count_if(F.col("value") > 0) / F.max(n)) * 100).alias("pct_dropout"),
    )


def normalise(x: DataFrame, target: float = 1e4, log: bool = True) -> DataFrame:
    """Values scaled so that every cell sums to ``target``, then ``log1p``; a cell that sums to zero stays as it is."""
    total = F.sum(v()).over(Window.partitionBy("cell_id"))
    scaled = v() * target / F.when(total == 0, 1.0).otherwise(total)
    return x.withColumn("value", F.log1p(scaled) if log else scaled)


def group_means(x: DataFrame, labels: DataFrame, log: bool = True) -> DataFrame:
    """Mean of every gene over all cells of each group, zeros included; ``log1p`` of it if asked.

    ``labels(cell_id, grp)``; cells without a label are left out. Pairs without any stored value are absent.
    """
    sizes = labels.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    sums = x.join(labels.where("grp is not null"), "cell_id").groupBy("grp", "gene_id").agg(F.sum(v()).alias("s"))
    mean = F.col("s") / F.col("n")
    return sums.join(sizes, "grp").select("grp", "gene_id", (F.log1p(mean) if log else mean).alias("mean"))


def group_sums(x: DataFrame, labels: DataFrame, by: list[str]) -> DataFrame:
    """Pseudobulk: summed values, cells with any and stored pairs per combination of labels and gene."""
    return x.join(labels, "cell_id").groupBy(*by, "gene_id").agg(F.sum(v()).alias("total"), F.count(F.lit(1)).alias("n_cells"))


def moments(x: DataFrame, n_cells: int) -> DataFrame:
    """Mean and sample variance of each gene over all cells, from the sums of values and squares."""
    mean = F.sum(v()) / n_cells
    return x.groupBy("gene_id").agg(
        mean.alias("mean"), ((F.sum(v() * v()) - F.sum(v()) * F.sum(v()) / n_cells) / max(n_cells - 1, 1)).alias("variance")
    )


def variable_genes(x: DataFrame, n_cells: int, top: int, forced: list[str] | None = None) -> DataFrame:
    """The ``top`` genes by variance over mean, then by name, and the forced ones after them."""
    m = moments(x, n_cells).withColumn("dispersion", F.try_divide("variance", "mean"))
    rank = F.row_number().over(Window.orderBy(F.desc_nulls_last("dispersion"), "gene_id"))  # one row for each gene
    return m.withColumn("rank", rank).where((F.col("rank") <= top) | F.col("gene_id").isin(forced or []))


def score_set(x: DataFrame, n_cells: int, genes: list[str], bins: int = 25) -> DataFrame:
    """Mean of a gene set minus mean of its control genes: all other genes in the bins of mean where the set lies."""
    order = Window.orderBy("mean", "gene_id")
    binned = moments(x, n_cells).select("gene_id", F.ntile(bins).over(order).alias("bin"), F.col("gene_id").isin(genes).alias("in_set"))
    used = binned.where("in_set").select("bin").distinct()
    control = binned.where("not in_set").join(used, "bin", "left_semi").select("gene_id", F.lit(False).alias("in_set"))
    chosen = binned.where("in_set").select("gene_id", "in_set").unionByName(control)
    n_set, n_control = (F.sum(F.col("in_set").cast("int")), F.sum((~F.col("in_set")).cast("int")))
    sizes = chosen.agg(n_set.alias("n_set"), n_control.alias("n_control"))
    part = lambda flag, n: F.coalesce(F.try_divide(F.sum(F.when(flag, v()).otherwise(0.0)), F.max(n)), F.lit(0.0))
    return x.join(chosen, "gene_id").crossJoin(F.broadcast(sizes)).groupBy("cell_id").agg(
        (part(F.col("in_set"), "n_set") - part(~F.col("in_set"), "n_control")).alias("score")
    )


def best_label(scores: DataFrame, key: str, label: str = "label", score: str = "score") -> DataFrame:
    """The label with the highest score of each key, ties by name."""
    order = Window.partitionBy(key).orderBy(F.desc(score), label)
    return scores.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def pearson_residuals(x: DataFrame, theta: float = 100.0, clip: float | None = None) -> DataFrame:
    """Analytic residuals ``(v - mu) / sqrt(mu + mu^2 / theta)`` of the stored values."""
    cell = F.sum(v()).over(Window.partitionBy("cell_id"))
    genes = x.groupBy("gene_id").agg(F.sum(v()).alias("__gene"))
    total = x.agg(F.sum(v()).alias("__total"))
    with_sums = x.withColumn("__cell", cell).join(genes, "gene_id").crossJoin(F.broadcast(total))
    mu = F.col("__cell") * F.col("__gene") / F.col("__total")
    r = (v() - mu) / F.sqrt(mu + mu * mu / theta)
    return with_sums.select("cell_id", "gene_id", (F.greatest(F.least(r, F.lit(clip)), F.lit(-clip)) if clip else r).alias("residual"))


def regress_out(x: DataFrame, covariate: DataFrame) -> DataFrame:
    """Residuals of the stored values after the line on one covariate that fits all cells, zeros included.

    ``covariate(cell_id, c)`` has every cell. Slope and intercept come from sums, as absent values add nothing to them.
    """
    c = covariate.agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("sc"), F.sum(F.col("c") * F.col("c")).alias("scc"))
    joined = x.join(covariate, "cell_id")
    sums = joined.groupBy("gene_id").agg(F.sum(v()).alias("sv"), F.sum(v() * F.col("c")).alias("scv")).crossJoin(F.broadcast(c))
    slope = F.coalesce(F.try_divide(F.expr("n * scv - sc * sv"), F.expr("n * scc - sc * sc")), F.lit(0.0))
    lines = sums.withColumn("slope", slope).select("gene_id", "slope", F.expr("(sv - slope * sc) / n").alias("intercept"))
    return joined.join(lines, "gene_id").select("cell_id", "gene_id", (v() - F.col("intercept") - F.col("slope") * F.col("c")).alias("residual"))


def _selected(x: DataFrame, cells: DataFrame, genes: list[str]) -> DataFrame:
    """``cell_id, gene_id, value`` for every cell and each of a few selected genes, zeros included."""
    grid = cells.select("cell_id").withColumn("gene_id", F.explode(F.array(*[F.lit(g) for g in genes]).cast("array<string>")))
    own = x.where(F.col("gene_id").isin(genes)).select("cell_id", "gene_id", v().alias("value"))
    return grid.join(own, ["cell_id", "gene_id"], "left").na.fill(0.0, ["value"])


def selected_residuals(x: DataFrame, cells: DataFrame, genes: list[str], theta: float = 100.0, clip: float | None = None) -> DataFrame:
    """Analytic residuals of a few genes in every cell, those without a stored value included; a cell without counts has 0."""
    per_cell = x.groupBy("cell_id").agg(F.sum(v()).alias("__cell"))
    genes_ = x.where(F.col("gene_id").isin(genes)).groupBy("gene_id").agg(F.sum(v()).alias("__gene"))
    total = x.agg(F.sum(v()).alias("__total"))
    j = _selected(x, cells, genes).join(per_cell, "cell_id", "left").join(genes_, "gene_id", "left").crossJoin(F.broadcast(total))
    mu = F.coalesce(F.try_divide(F.col("__cell") * F.col("__gene"), "__total"), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("value") - mu, F.sqrt(mu + mu * mu / theta)), F.lit(0.0))
    return j.select("cell_id", "gene_id", (F.greatest(F.least(r, F.lit(clip)), F.lit(-clip)) if clip else r).alias("residual"))


def selected_regressed(x: DataFrame, covariate: DataFrame, genes: list[str]) -> DataFrame:
    """Residuals of a few genes in every cell of ``covariate(cell_id, c)`` after the line on it, zeros included."""
    full = _selected(x, covariate, genes).join(covariate, "cell_id")
    lines = full.groupBy("gene_id").agg(F.regr_slope("value", "c").alias("slope"), F.avg("value").alias("mv"), F.avg("c").alias("mc"))
    slope = F.coalesce("slope", F.lit(0.0))
    return full.join(lines, "gene_id").select("cell_id", "gene_id", (F.col("value") - F.col("mv") - slope * (F.col("c") - F.col("mc"))).alias("residual"))


def repaired(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN and infinities become 0; ``n_repaired`` counts them per row."""
    bad = {c: F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in columns}
    out = df.withColumn("n_repaired", sum((F.coalesce(b, F.lit(False)).cast("int") for b in bad.values()), F.lit(0)))
    return out.withColumns({c: F.when(b, 0.0).otherwise(F.col(c)) for c, b in bad.items()})


def proportions(abundance: DataFrame, key: str, value: str) -> DataFrame:
    """Each row's share of its key's total; 0 where the total is 0."""
    total = F.sum(value).over(Window.partitionBy(key))
    return abundance.withColumn("share", F.coalesce(F.try_divide(F.col(value), total), F.lit(0.0)))
