"""Quality thresholds and filters. NaN never fails a threshold, as a comparison with it is false."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrel.operators import stats
from spindrel.runtime import checkpoint

SIGMA = 1.482602218505602  # median absolute deviation to standard deviation


@dataclass(frozen=True)
class Limits:
    """Limits of quality control; None is no limit."""

    min_genes: float | None = None
    max_genes: float | None = None
    max_mt: float | None = None
    max_total: float | None = None
    min_complexity: float | None = None


def _beyond(column: str, low: float | None = None, high: float | None = None) -> Column:
    c, out = F.col(column), F.lit(False)
    real = c.isNotNull() & ~F.isnan(c.cast("double"))
    if low is not None:
        out = out | (real & (c < low))
    if high is not None:
        out = out | (real & (c > high))
    return out


def keep_cells(metrics: DataFrame, limits: Limits, doublet: Column | None = None) -> DataFrame:
    """Cells within all limits that are no doublets."""
    bad = _beyond("n_genes", limits.min_genes, limits.max_genes) | _beyond("pct_mt", None, limits.max_mt)
    bad = bad | _beyond("total", None, limits.max_total) | _beyond("complexity", limits.min_complexity)
    return metrics.where(~bad if doublet is None else ~bad & ~F.coalesce(doublet, F.lit(False)))


def mad_limits(metrics: DataFrame, column: str, k: float, floor: float | None = None, cap: float | None = None) -> DataFrame:
    """``median``, scaled ``mad`` and ``low``/``high`` = median -/+ k mad, clamped to ``floor`` and ``cap``; one row."""
    values = checkpoint(metrics.select(column))
    (median,) = stats.quantiles(values, column, [0.5])
    off = values.select(F.abs(F.col(column) - F.lit(median)).alias("off"))
    (mad,) = stats.quantiles(off, "off", [0.5])
    row = metrics.sparkSession.range(1).select(F.lit(median).cast("double").alias("median"), (F.lit(mad).cast("double") * SIGMA).alias("mad"))
    low, high = F.col("median") - k * F.col("mad"), F.col("median") + k * F.col("mad")
    return row.select(
        "median", "mad", (low if floor is None else F.greatest(low, F.lit(floor))).alias("low"),
        (high if cap is None else F.least(high, F.lit(cap))).alias("high"),
    )


def adaptive_limits(metrics: DataFrame, column: str, k: float, hard_low: float, hard_high: float | None = None, spread: float = 2000.0, reliable: float = 1500.0) -> DataFrame:
    """Limits by deviations from the median, or the hard ones where those cannot be relied upon; one row.

    They cannot if the middle 80 % are wider than ``spread`` while the median is below ``reliable``. The lower limit is never above the
    hard one, the upper one not above ``hard_high``.
    """
    values = checkpoint(metrics.select(column))
    p10, median, p90 = stats.quantiles(values, column, [0.1, 0.5, 0.9])
    (mad,) = stats.quantiles(values.select(F.abs(F.col(column) - F.lit(median)).alias("off")), "off", [0.5])
    row = metrics.sparkSession.range(1).select(*[F.lit(x).cast("double").alias(n) for n, x in (("p10", p10), ("median", median), ("p90", p90), ("mad", mad))])
    row = row.withColumn("mad", F.col("mad") * SIGMA).withColumn("fallback", (F.col("p90") - F.col("p10") > spread) & (F.col("median") < reliable))
    low, high = F.greatest(F.col("median") - k * F.col("mad"), F.lit(0.0)), F.col("median") + k * F.col("mad")
    top = F.lit(hard_high).cast("double")
    return row.select(
        "median", "fallback", F.when(F.col("fallback"), F.lit(float(hard_low))).otherwise(F.least(low, F.lit(float(hard_low)))).alias("low"),
        F.when(F.col("fallback"), top).otherwise(F.least(high, F.coalesce(top, high))).alias("high"),
    )


def keep_genes(x: DataFrame, kept: DataFrame, min_cells: int) -> DataFrame:
    """Rows of kept cells and of genes above zero in at least ``min_cells`` of them."""
    rows = x.join(kept.select("cell_id"), "cell_id", "left_semi")
    genes = rows.groupBy("gene_id").agg(F.count_if(F.col("value") > 0).alias("n")).where(F.col("n") >= min_cells)
    return rows.join(genes, "gene_id", "left_semi")


def stable_threshold(scores: DataFrame, score: str, threshold: float, rate: float, shift: float = 0.05, most: float = 0.05) -> DataFrame:
    """The threshold, or the ``1 - rate`` percentile if moving it by ``shift`` changes the share above by more than ``most``."""
    scores = checkpoint(scores.select(score))
    above = lambda t: F.avg((F.col(score) > t).cast("double"))
    (p,) = stats.quantiles(scores, score, [1 - rate])
    row = scores.agg(above(threshold * (1 - shift)).alias("lo"), above(threshold).alias("at"), above(threshold * (1 + shift)).alias("hi"))
    change = F.greatest(F.abs(F.col("lo") - F.col("at")), F.abs(F.col("hi") - F.col("at")))
    return row.select((change <= most).alias("stable"), F.when(change <= most, F.lit(float(threshold))).otherwise(F.lit(p).cast("double")).alias("threshold"))


def doublet_rate(n_cells: Column) -> Column:
    """Expected share of doublets, a line in the number of cells, within 0.4 and 15 %."""
    return F.greatest(F.lit(0.004), F.least(F.lit(0.15), (0.000759 * n_cells + 5.3e-7 * 100) / 100))
