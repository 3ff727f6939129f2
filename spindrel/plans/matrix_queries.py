"""Queries on the matrix: quality, normalisation, pseudobulk, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.operators import matrix, quality, sampling
from spindrel.plans import roles
from spindrel.plans.book import Book

BOOK = Book(roles.SQL)
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def gene_sets() -> tuple[Column, Column]:
    """One brand in the role of mitochondrial genes, some in that of ribosomal ones."""
    return F.col("gene_id") == "Brand#1", F.col("gene_id").startswith("Brand#2")


R = 6
_METRICS = """m as (select cell_id, count(*) n_genes, sum("value") total, sum(case when gene_id = 'Brand#1' then "value" else 0 end) mt,
  sum(case when starts_with(gene_id, 'Brand#2') then "value" else 0 end) ribo, sum(case when k <= 2 then "value" else 0 end) top2
  from (select *, row_number() over (partition by cell_id order by "value" desc, gene_id) k from x) group by 1),
q as (select cell_id, n_genes, total, ln(1 + total) log1p_total, mt * 100 / total pct_mt, ribo * 100 / total pct_ribo, top2 * 100 / total pct_top,
  log10(n_genes) / log10(total) complexity from m)
"""


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, R) for c in columns})


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return matrix.cell_metrics(roles.counts(spark, d), *gene_sets(), top=2)


@query(_METRICS + """select cell_id, n_genes, total, round(log1p_total, 6) log1p_total, round(pct_mt, 6) pct_mt,
  round(pct_ribo, 6) pct_ribo, round(pct_top, 6) pct_top, round(complexity, 6) complexity from q""")
def qc_cell_metrics(spark, d):
    return _round(metrics(spark, d), "log1p_total", "pct_mt", "pct_ribo", "pct_top", "complexity")


@query("""n as (select count(*) c from obs) select gene_id, count(*) filter ("value" > 0) n_cells, sum("value") total,
  round(sum("value") / any_value(c), 6) mean, round((1 - count(*) filter ("value" > 0) / any_value(c)) * 100, 6) pct_dropout from x, n group by 1""")
def qc_gene_metrics(spark, d):
    n = roles.cells(spark, d).count()
    return _round(matrix.gene_metrics(roles.counts(spark, d), n), "mean", "pct_dropout")


@query(_METRICS + "select cell_id, n_genes, total from q where not (n_genes < 2 or n_genes > 12 or pct_mt > 60 or total > 400 or complexity < 0.1)")
def qc_filter_cells(spark, d):
    limits = quality.Limits(min_genes=2, max_genes=12, max_mt=60, max_total=400, min_complexity=0.1)
    return quality.keep_cells(metrics(spark, d), limits).select("cell_id", "n_genes", "total")


@query(_METRICS + """, med as (select median(total) v from q), dev as (select median(abs(total - v)) * 1.482602218505602 mad from q, med)
  select round(v, 6) median, round(mad, 6) mad, round(greatest(v - 5 * mad, 0.0), 6) low, round(least(v + 5 * mad, 4000.0), 6) high from med, dev""")
def qc_mad_limits(spark, d):
    return _round(quality.mad_limits(metrics(spark, d), "total", 5, 0.0, 4000.0), "median", "mad", "low", "high")


@query(_METRICS + """, k as (select cell_id from q where not (n_genes < 2)), r as (select x.* from x semi join k using (cell_id)),
  g as (select gene_id from r group by 1 having count(*) filter ("value" > 0) >= 100)
  select gene_id, count(*) n_rows, sum("value") total from r semi join g using (gene_id) group by 1""")
def qc_filter_genes(spark, d):
    kept = quality.keep_cells(metrics(spark, d), quality.Limits(min_genes=2))
    rows = quality.keep_genes(roles.counts(spark, d), kept, 100)
    return rows.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total"))


@query("""t as (select cell_id, sum("value") s from x group by 1) select x.cell_id, x.gene_id, round(ln(1 + "value" * 1e4 / case when s = 0 then 1 else s end), 6) as "value" from x join t using (cell_id)""")
def normalise_log1p(spark, d):
    return _round(matrix.normalise(roles.counts(spark, d)), "value")


@query("""s as (select "cluster" grp, count(*) n from obs group by 1) select o."cluster" grp, gene_id, round(ln(1 + sum("value") / any_value(n)), 6) mean
  from x join obs o using (cell_id) join s on s.grp = o."cluster" group by 1, 2""")
def pseudobulk_mean(spark, d):
    labels = roles.cells(spark, d).select("cell_id", F.col("cluster").alias("grp"))
    return _round(matrix.group_means(roles.counts(spark, d), labels), "mean")


@query("""p as (select sample, "cluster", gene_id, sum("value") total, count(*) n_cells from x join obs using (cell_id) group by all) select * from p""")
def pseudobulk_sum(spark, d):
    return matrix.group_sums(roles.counts(spark, d), roles.cells(spark, d).select("cell_id", "sample", "cluster"), ["sample", "cluster"])


_MOMENTS = """n as (select count(*) c from obs), mo as (select gene_id, sum("value") / any_value(c) mean,
  (sum("value" * "value") - sum("value") * sum("value") / any_value(c)) / (any_value(c) - 1) variance from x, n group by 1),"""


@query(_MOMENTS + """r as (select *, row_number() over (order by variance / mean desc nulls last, gene_id) as rank from mo)
  select gene_id, round(mean, 6) mean, round(variance, 6) variance, rank from r where rank <= 10 or gene_id = 'Brand#7'""")
def variable_genes(spark, d):
    x, n = roles.counts(spark, d), roles.cells(spark, d).count()
    return _round(matrix.variable_genes(x, n, 10, ["Brand#7"]), "mean", "variance").select("gene_id", "mean", "variance", F.col("rank").cast("bigint").alias("rank"))


@query(_MOMENTS + """b as (select gene_id, ntile(5) over (order by mean, gene_id) bin, gene_id in ('Brand#1', 'Brand#2', 'Brand#3') s from mo),
  c as (select gene_id, s from b where s or bin in (select bin from b where s)), k as (select count(*) filter (s) ns, count(*) filter (not s) nc from c)
  select cell_id, round(coalesce(sum(case when s then "value" else 0 end) / nullif(max(ns), 0), 0) - coalesce(sum(case when not s then "value" else 0 end) / nullif(max(nc), 0), 0), 6) score
  from x join c using (gene_id), k group by 1""")
def score_genes(spark, d):
    x, n = roles.counts(spark, d), roles.cells(spark, d).count()
    return _round(matrix.score_set(x, n, ["Brand#1", "Brand#2", "Brand#3"], 5), "score")


@query("""s as (select cell_id, case when gene_id < 'Brand#2' then 'early' else 'late' end label, sum("value") score from x group by 1, 2)
  select cell_id, label, score from s qualify row_number() over (partition by cell_id order by score desc, label) = 1""")
def label_by_best_score(spark, d):
    label = F.when(F.col("gene_id") < "Brand#2", "early").otherwise("late")
    scores = roles.counts(spark, d).groupBy("cell_id", label.alias("label")).agg(F.sum("value").alias("score"))
    return matrix.best_label(scores, "cell_id")


@query("""c as (select cell_id, sum("value") s from x group by 1), g as (select gene_id, sum("value") t from x group by 1), a as (select sum("value") z from x),
  e as (select cell_id, gene_id, "value" v, s * t / z mu from x join c using (cell_id) join g using (gene_id), a)
  select cell_id, gene_id, round(greatest(least((v - mu) / sqrt(mu + mu * mu / 100), 10), -10), 6) residual from e""")
def pearson_residuals(spark, d):
    return _round(matrix.pearson_residuals(roles.counts(spark, d), clip=10.0), "residual")


@query("""cv as (select cell_id, price c from obs), t as (select count(*) n, sum(c) sc, sum(c * c) scc from cv),
  l as (select gene_id, sum("value") sv, sum("value" * c) scv from x join cv using (cell_id) group by 1),
  f as (select gene_id, (n * scv - sc * sv) / (n * scc - sc * sc) b, sv, sc, n from l, t)
  select cell_id, gene_id, round("value" - (sv - b * sc) / n - b * c, 4) residual from x join cv using (cell_id) join f using (gene_id)""")
def regress_out(spark, d):
    covariate = roles.cells(spark, d).select("cell_id", F.col("price").alias("c"))
    return matrix.regress_out(roles.counts(spark, d), covariate).withColumn("residual", F.round("residual", 4))


@query("""select row_id, case when isnan(pct_counts_mt) or isinf(pct_counts_mt) then 0 else pct_counts_mt end pct_counts_mt,
  case when isnan(pct_counts_mt) or isinf(pct_counts_mt) then 1 else 0 end n_repaired from obs_annotated""", prelude="")
def repair_nan(spark, d):
    obs = roles.table(spark, d, "obs_annotated").select("row_id", F.col("pct_counts_mt").cast("double").alias("pct_counts_mt"))
    return matrix.repaired(obs, ["pct_counts_mt"]).select("row_id", "pct_counts_mt", "n_repaired")


@query("""select cell_id, gene_id, "value", round("value" / sum("value") over (partition by cell_id), 6) share from x where true""".replace("select cell_id", "z as (select 1) select cell_id", 1))
def cell_proportions(spark, d):
    return _round(matrix.proportions(roles.counts(spark, d), "cell_id", "value"), "share")


_ALLOC = """s as (select "cluster", count(*) n from obs group by 1), e as (select *, n * 1000 / sum(n) over () ex from s),
  a as (select "cluster", n, floor(ex)::bigint + case when row_number() over (order by ex - floor(ex) desc, "cluster") <= 1000 - sum(floor(ex)) over () then 1 else 0 end n_sample from e)
"""


@query(_ALLOC + 'select "cluster", n, n_sample from a')
def stratified_allocation(spark, d):
    return sampling.allocation(roles.cells(spark, d), "cluster", 1000)


@query(_ALLOC + 'select "cluster", n_sample n_drawn from a')
def stratified_sample(spark, d):
    """How many cells of each group a stratified sample holds."""
    drawn = sampling.stratified(roles.cells(spark, d), "cell_id", "cluster", 1000)
    return drawn.groupBy("cluster").agg(F.countDistinct("cell_id").alias("n_drawn"))


@query("z as (select 1) select sample, least(count(*), 500) n_drawn from obs group by 1")
def capped_sample(spark, d):
    """How many cells of each sample remain under a limit."""
    drawn = sampling.per_stratum(roles.cells(spark, d), "cell_id", "sample", F.lit(500))
    return drawn.groupBy("sample").agg(F.countDistinct("cell_id").alias("n_drawn"))


@query("z as (select 1) select least(count(*), 1234) n_drawn from obs where sample in ('BUILDING', 'MACHINERY') and price > 100000 and condition = 'F'")
def filtered_random_sample(spark, d):
    """Filter, then draw: the number drawn."""
    kept = sampling.selected(roles.cells(spark, d), "sample", ["BUILDING", "MACHINERY"], "price > 100000 and condition = 'F'")
    return sampling.sample_n(kept, "cell_id", 1234).agg(F.countDistinct("cell_id").alias("n_drawn"))


@query("""l as (select avg((price > 285000)::double) lo, avg((price > 300000)::double) "at", avg((price > 315000)::double) hi, quantile_cont(price, 0.94) p from obs)
  select greatest(abs(lo - "at"), abs(hi - "at")) <= 0.01 stable, round(case when greatest(abs(lo - "at"), abs(hi - "at")) <= 0.01 then 300000 else p end, 4) threshold from l""")
def stable_threshold(spark, d):
    out = quality.stable_threshold(roles.cells(spark, d), "price", 300000.0, 0.06, most=0.01)
    return out.withColumn("threshold", F.round("threshold", 4))


@query("""z as (select 1) select sample, count(*) n, round(greatest(0.004, least(0.15, (0.000759 * count(*) + 5.3e-5) / 100)), 9) rate from obs group by 1""")
def expected_doublet_rate(spark, d):
    return roles.cells(spark, d).groupBy("sample").agg(F.count(F.lit(1)).alias("n")).withColumn("rate", F.round(quality.doublet_rate(F.col("n")), 9))


@query("""s as (select "cluster" grp, count(*) n from obs group by 1), p as (select o."cluster" grp, gene_id, ln(1 + sum(v) / any_value(n)) mean
  from (select x.cell_id, gene_id, ln(1 + "value" * 1e4 / sum("value") over (partition by cell_id)) v, count(*) over (partition by cell_id) g from x) y
  join obs o using (cell_id) join s on s.grp = o."cluster" where g >= 2 group by 1, 2)
  select grp, gene_id, round(mean, 6) mean, rank from (select *, row_number() over (partition by grp order by round(mean, 9) desc, gene_id) as rank from p) where rank <= 5""")
def top_genes_per_group(spark, d):
    """Quality control, filter, normalisation, pseudobulk and the five strongest genes of each group."""
    x = roles.counts(spark, d)
    kept = quality.keep_cells(matrix.cell_metrics(x, *gene_sets(), top=2), quality.Limits(min_genes=2))
    norm = matrix.normalise(x.join(kept.select("cell_id"), "cell_id", "left_semi"))
    labels = roles.cells(spark, d).select("cell_id", F.col("cluster").alias("grp"))
    means = matrix.group_means(norm, labels)
    order = Window.partitionBy("grp").orderBy(F.desc(F.round("mean", 9)), "gene_id")
    top = means.withColumn("rank", F.row_number().over(order).cast("bigint")).where("rank <= 5")
    return _round(top, "mean")


_CHOSEN = ["Brand#1", "Brand#2", "Brand#12"]


@query("""c as (select cell_id, sum("value")::double s from x group by 1), g as (select gene_id, sum("value")::double t from x where gene_id in ('Brand#1', 'Brand#2', 'Brand#12') group by 1), a as (select sum("value")::double z from x),
  e as (select o.cell_id, g.gene_id, coalesce(x."value", 0) v, coalesce(s, 0) * t / z mu from obs o cross join g cross join a left join c using (cell_id) left join x on x.cell_id = o.cell_id and x.gene_id = g.gene_id)
  select cell_id, gene_id, round(case when mu > 0 then greatest(least((v - mu) / sqrt(mu + mu * mu / 100), 10), -10) else 0 end, 6) + 0.0 residual from e""")
def selected_residuals(spark, d):
    """Residuals of three genes in every order, with and without them."""
    out = matrix.selected_residuals(roles.counts(spark, d), roles.cells(spark, d), _CHOSEN, clip=10.0)
    return _round(out, "residual").withColumn("residual", F.col("residual") + F.lit(0.0))


@query("""e as (select o.cell_id, g.gene_id, coalesce(x."value", 0)::double v, price c from obs o cross join (select unnest(['Brand#1', 'Brand#2', 'Brand#12']) gene_id) g left join x on x.cell_id = o.cell_id and x.gene_id = g.gene_id),
  l as (select gene_id, regr_slope(v, c) b, avg(v) mv, avg(c) mc from e group by 1) select cell_id, gene_id, round(v - mv - b * (c - mc), 4) + 0.0 residual from e join l using (gene_id)""")
def selected_regressed(spark, d):
    """Residuals of three genes on the price of every order."""
    covariate = roles.cells(spark, d).select("cell_id", F.col("price").alias("c"))
    return matrix.selected_regressed(roles.counts(spark, d), covariate, _CHOSEN).withColumn("residual", F.round("residual", 4) + F.lit(0.0))


@query("""o as (select n_genes_by_counts::double v from obs_annotated where n_genes_by_counts is not null), m as (select median(v) md, quantile_cont(v, 0.1) a, quantile_cont(v, 0.9) b from o), d as (select median(abs(v - md)) * 1.482602218505602 mad from o, m)
  select md median, b - a > 2000 and md < 1500 fallback, round(case when b - a > 2000 and md < 1500 then 200.0 else least(greatest(md - 3 * mad, 0), 200.0) end, 6) low, round(case when b - a > 2000 and md < 1500 then 9000.0 else least(md + 3 * mad, 9000.0) end, 6) high from m, d""", prelude="with ")
def adaptive_limits(spark, d):
    """Limits of the number of genes, adaptive where that can be relied upon."""
    return _round(quality.adaptive_limits(roles.table(spark, d, "obs_annotated"), "n_genes_by_counts", 3, 200.0, 9000.0), "low", "high")
