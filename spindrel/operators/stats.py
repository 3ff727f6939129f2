"""Statistical kernels as column expressions and aggregates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from spindrel.runtime import checkpoint


def midrank(value: Column | str, *by: str) -> Column:
    """Rank with ties averaged, within the partition ``by``."""
    v = F.col(value) if isinstance(value, str) else value
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, v))
    return F.rank().over(Window.partitionBy(*by).orderBy(v)) + (ties - 1) / 2


def benjamini_hochberg(df: DataFrame, p: str, *by: str, out: str = "p_adj") -> DataFrame:
    """Adjusted p-values within ``by``: ``p m / rank``, made monotone from the largest down, 1 at most.

    Null and NaN p-values count for nothing and stay null.
    """
    ok = F.col(p).isNotNull() & ~F.isnan(p)
    w = Window.partitionBy(*by, ok)
    ranked = df.withColumn("__m", F.count(F.lit(1)).over(w)).withColumn("__k", F.row_number().over(w.orderBy(p)))
    down = w.orderBy(F.desc("__k")).rowsBetween(Window.unboundedPreceding, 0)
    adjusted = F.least(F.lit(1.0), F.min(F.col(p) * F.col("__m") / F.col("__k")).over(down))
    return ranked.withColumn(out, F.when(ok, adjusted)).drop("__m", "__k")


def quantiles(df: DataFrame, column: str, at: list[float], in_memory: int = 200_000, bins: int = 4096) -> list[float | None]:
    """Exact quantiles, interpolated between neighbours, of the values that are neither null nor NaN; None without any.

    Values are counted in bins between the least and the greatest; the bin in which a rank lies is divided again, until at
    most ``in_memory`` values are left, or one. No task holds more distinct values than that.
    """
    v = F.col(column).cast("double")
    values = checkpoint(df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")))
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()

    def ranked(k: int) -> float:
        lo, hi, below, inside, part = low, high, 0, n, values
        while inside > in_memory and lo < hi:
            bin_ = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1)).alias("b")
            rows = part.groupBy(bin_).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()  # at most ``bins``
            for r in rows:
                if below + r["n"] > k:
                    lo, hi, inside = r["lo"], r["hi"], r["n"]
                    break
                below += r["n"]
            part = values.where(F.col("v").between(lo, hi))
        if lo == hi:
            return lo
        return part.agg(F.sort_array(F.collect_list("v"))[k - below]).first()[0]

    out: list[float | None] = []
    for p in at:
        place = p * (n - 1)
        k = math.floor(place)
        if not n:
            out.append(None)
        else:
            a = ranked(k)
            out.append(a if place == k else a + (place - k) * (ranked(k + 1) - a))
    return out


def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation; null where one side is constant."""
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.covar_pop(a, b) / F.when(spread > 0, spread)


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """Two-sided p-value of a normal score."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2)) if v is not None and v == v else None)


def rank_sums(x: DataFrame, labels: DataFrame, buckets: int = 16) -> DataFrame:
    """Wilcoxon rank sums of each gene for each group against the rest, without making zeros real.

    Values are not negative. The zeros of a gene are one block of ties at the bottom: with ``z`` of them a
    stored value's rank is ``z`` plus its rank among the stored ones. Result: ``grp, gene_id, n, rank_sum, z``
    with the tie-corrected normal score (0 where it is undefined). Only genes with a stored value come out.

    Equal values of a group are one row before they are sorted. A gene is sorted in ``buckets`` parts between
    approximate quantiles, each part's ranks begin where the counts of the lower parts end, so that no task
    holds a whole gene.
    """
    return group_sums(x, labels, buckets).select("grp", "gene_id", "n", "rank_sum", "z")


def group_sums(x: DataFrame, labels: DataFrame, buckets: int = 16) -> DataFrame:
    """``rank_sums`` with the sum and number of the stored values: ``s, m`` of the group, ``s_all, nnz`` of all, ``n_all`` cells."""
    labels = labels.where("grp is not null")
    sizes = labels.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    total = labels.agg(F.count(F.lit(1)).alias("n_all"))
    counts = checkpoint(x.where("value > 0").join(labels, "cell_id").groupBy("gene_id", "value", "grp").agg(F.count(F.lit(1)).alias("c")))
    at = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = counts.groupBy("gene_id").agg(F.percentile_approx("value", at, F.lit(1000)).alias("cuts"))
    parts = counts.join(cuts, "gene_id").withColumn("part", F.size(F.filter("cuts", lambda q: q < F.col("value")))).drop("cuts")
    below = F.sum("k").over(Window.partitionBy("gene_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.groupBy("gene_id", "part").agg(F.sum("c").alias("k")).select("gene_id", "part", F.coalesce(below, F.lit(0)).alias("offset"))
    upto = F.sum("c").over(Window.partitionBy("gene_id", "part").orderBy("value").rangeBetween(Window.unboundedPreceding, 0))
    ties = F.sum("c").over(Window.partitionBy("gene_id", "part", "value"))
    ranked = parts.withColumn("t", ties).withColumn("upto", upto).join(offsets, ["gene_id", "part"])
    rank = F.col("offset") + F.col("upto") - F.col("t") + (F.col("t") + 1) / 2
    t = F.col("t").cast("double")
    sums = ranked.groupBy("grp", "gene_id").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("value").cast("double")).alias("s"), F.sum(F.col("c") * rank).alias("r"), F.sum(F.col("c") * (t * t - 1)).alias("ties"))
    per_gene = sums.groupBy("gene_id").agg(F.sum("m").alias("nnz"), F.sum("ties").alias("tie_sum"), F.sum("s").alias("s_all"))
    grid = per_gene.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(total))  # genes x groups
    full = grid.join(sums.drop("ties"), ["grp", "gene_id"], "left").na.fill({"m": 0, "r": 0.0, "s": 0.0}).withColumn("zeros", F.col("n_all") - F.col("nnz"))
    rank_sum = F.expr("r + m * zeros + (n - m) * (1 + zeros) / 2.0")
    tie = F.expr("1 - (tie_sum + cast(zeros as double) * zeros * zeros - zeros) / (cast(n_all as double) * n_all * n_all - n_all)")
    full = full.withColumn("rank_sum", rank_sum).withColumn("__tie", tie)
    sigma = F.sqrt(F.greatest(F.lit(0.0), F.col("__tie")) * F.expr("cast(n as double) * (n_all - n) * (n_all + 1) / 12"))
    z = F.coalesce(F.try_divide(F.expr("rank_sum - n * (n_all + 1) / 2.0"), F.when(sigma > 0, sigma)), F.lit(0.0))
    return full.select("grp", "gene_id", "n", "rank_sum", z.alias("z"), "s", "m", "s_all", "nnz", "n_all")


def spearman(df: DataFrame, a: str, b: str, *by: str) -> DataFrame:
    """Rank correlation of two columns within ``by``; null where one of them is constant."""
    ranked = df.select(*by, midrank(a, *by).alias("ra"), midrank(b, *by).alias("rb"))
    return ranked.groupBy(*by).agg(correlation("ra", "rb").alias("rho"), F.count(F.lit(1)).alias("n"))


def sparse_spearman(x: DataFrame, covariate: DataFrame) -> DataFrame:
    """``gene_id, n, rho``: rank correlation of each gene with a covariate over all its cells, zeros included.

    ``x(cell_id, gene_id, value)`` has no negative values, ``covariate(cell_id, t)`` every cell once. The zeros of a gene are one block of
    ties at the bottom, whose part of the sums follows from the totals, so nothing is made dense. Null where one side is constant.
    """
    ranked = checkpoint(covariate.where("t is not null").select("cell_id", midrank("t").alias("rt")))
    total = ranked.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("rt").alias("st"), F.sum(F.col("rt") * F.col("rt")).alias("qt"))
    stored = x.where("value > 0").join(ranked, "cell_id").select("gene_id", "rt", midrank("value", "gene_id").alias("k"))
    per = stored.groupBy("gene_id").agg(
        F.count(F.lit(1)).cast("double").alias("m"), F.sum("k").alias("sk"), F.sum(F.col("k") * F.col("k")).alias("qk"), F.sum(F.col("k") * F.col("rt")).alias("skt"), F.sum("rt").alias("sm")
    ).crossJoin(F.broadcast(total)).withColumn("z", F.expr("n - m")).withColumn("r0", F.expr("(1 + z) / 2"))
    # A stored value's rank is the number of zeros and its rank among the stored ones.
    sx, qx, sxt = F.expr("sk + m * z + z * r0"), F.expr("qk + 2 * z * sk + m * z * z + z * r0 * r0"), F.expr("skt + z * sm + r0 * (st - sm)")
    spread = (F.col("n") * qx - sx * sx) * F.expr("n * qt - st * st")
    return per.select("gene_id", F.col("n").cast("bigint").alias("n"), ((F.col("n") * sxt - sx * F.col("st")) / F.sqrt(F.when(spread > 0, spread))).alias("rho"))


def anova_r2(long: DataFrame, label: str, component: str = "pc", value: str = "v") -> DataFrame:
    """Share of each component's variance between labels; 0 where there is no variance."""
    groups = long.groupBy(component, label).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    between = F.sum(F.col("s") * F.col("s") / F.col("n")) - F.sum("s") * F.sum("s") / F.sum("n")
    whole = F.sum("q") - F.sum("s") * F.sum("s") / F.sum("n")
    return groups.groupBy(component).agg(F.coalesce(F.try_divide(between, whole), F.lit(0.0)).alias("r2"))


def gini(df: DataFrame, value: str) -> DataFrame:
    """Gini index of a short column; 0 if it sums to 0."""
    ranked = df.select(F.col(value).alias("v"), F.row_number().over(Window.orderBy(value)).alias("i"))
    n = F.count(F.lit(1))
    g = 2 * F.sum(F.col("i") * F.col("v")) / (n * F.when(F.sum("v") != 0, F.sum("v"))) - (n + 1) / n
    return ranked.agg(F.coalesce(g, F.lit(0.0)).alias("gini"))


def batch_category(g: Column, batch: float = 0.3, biology: float = 0.6) -> Column:
    return F.when(g <= batch, "batch").when(g >= biology, "biology").otherwise("ambiguous")


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cramer's V of two columns, without correction; 0 if one of them has a single level."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    row, col, everything = Window.partitionBy(a), Window.partitionBy(b), Window.partitionBy()
    full = cells.withColumns({"r": F.sum("o").over(row), "c": F.sum("o").over(col), "n": F.sum("o").over(everything)})
    # chi2 = n (sum of o^2 / (r c) - 1): pairs that do not occur need no row.
    chi = F.max("n") * (F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))) - 1)
    least = F.least(F.countDistinct(a), F.countDistinct(b)) - 1
    return full.agg(F.when(least > 0, F.sqrt(F.greatest(chi, F.lit(0.0)) / (F.max("n") * least))).otherwise(0.0).alias("v"))


def purity(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Share of rows that bear the commonest label of their cluster."""
    n = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    top = n.groupBy(cluster).agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    return top.agg((F.sum("top") / F.sum("n")).alias("purity"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labellings; 1 if both are trivial in the same way."""
    pairs = lambda c: c * (c - 1) / 2
    count = lambda *k: df.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(pairs(F.col("n").cast("double"))).alias("s"))
    both, one, two = count(a, b), count(a).withColumnRenamed("s", "sa"), count(b).withColumnRenamed("s", "sb")
    n = df.agg(pairs(F.count(F.lit(1)).cast("double")).alias("all"))
    t = both.crossJoin(one).crossJoin(two).crossJoin(n)  # four single rows
    expected = F.expr("sa * sb / nullif(all, 0)")
    top, bottom = F.col("s") - expected, F.expr("(sa + sb) / 2") - expected
    return t.select(F.coalesce(F.try_divide(top, bottom), F.lit(1.0)).alias("ari"))


def _tail(hits: int, marked: int, drawn: int, total: int, at_once: int = 1 << 20) -> float:
    """The terms follow from each other by the ratio of neighbours, in logs, ``at_once`` of them at a time."""
    if hits <= 0:
        return 1.0
    low, top, rest = max(hits, drawn + marked - total), min(marked, drawn), total - marked - drawn
    if low > top:
        return 0.0
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    log, tail = choose(marked, low) + choose(total - marked, drawn - low) - choose(total, drawn), 0.0
    for start in range(low, top + 1, at_once):
        i = np.arange(start, min(start + at_once, top + 1), dtype=float)
        steps = np.log((marked - i[:-1]) * (drawn - i[:-1])) - np.log((i[:-1] + 1) * (rest + i[:-1] + 1))
        logs = log + np.concatenate([[0.0], np.cumsum(steps)])
        tail += float(np.exp(logs).sum())
        last = i[-1]
        if last < top:
            log = logs[-1] + math.log((marked - last) * (drawn - last)) - math.log((last + 1) * (rest + last + 1))
    return min(1.0, tail)


@F.pandas_udf(DoubleType())
def hypergeometric_tail(hits: pd.Series, marked: pd.Series, drawn: pd.Series, total: pd.Series) -> pd.Series:
    """P(X >= hits) when ``drawn`` of ``total`` are drawn and ``marked`` of them count, for totals of any size; null if one is null."""
    rows = zip(hits, marked, drawn, total, strict=True)
    return pd.Series([None if any(pd.isna(v) for v in r) else _tail(*map(int, r)) for r in rows], dtype="float64")


def linear_t(df: DataFrame, x: str, y: str, *by: str) -> DataFrame:
    """t-statistic of the slope of ``y`` on ``x`` within ``by``, by the correlation; null below 3 rows."""
    r = df.groupBy(*by).agg(correlation(x, y).alias("r"), F.count(F.lit(1)).alias("n"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, F.when(1 - F.col("r") * F.col("r") > 0, 1 - F.col("r") * F.col("r"))))
    return r.withColumn("t", F.when(F.col("n") > 2, t))
