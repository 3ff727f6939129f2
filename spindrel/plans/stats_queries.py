"""Queries of the statistical kernels and differential expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.operators import expression, matrix, stats
from spindrel.plans import roles
from spindrel.plans.book import Book
from spindrel.runtime import table

BOOK = Book(roles.SQL)
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def labelled(spark, d, label="cluster"):
    return roles.cells(spark, d).select("cell_id", F.col(label).alias("grp"))


_RANKS = """dense as (select o.cell_id, o."cluster" grp, g.gene_id, coalesce(x."value", 0) v from obs o cross join (select distinct gene_id from x) g
  left join x on x.cell_id = o.cell_id and x.gene_id = g.gene_id),
rk as (select *, rank() over (partition by gene_id order by v) + (count(*) over (partition by gene_id, v) - 1) / 2.0 r from dense),
ti as (select gene_id, sum(t::double * t * t - t) ts from (select gene_id, v, count(*) t from dense group by all) group by 1),
nn as (select count(*)::double c from obs),
rs as (select grp, gene_id, count(*)::double n, sum(r) rank_sum from rk group by all),
zs as (select grp, gene_id, n, rank_sum, coalesce((rank_sum - n * (c + 1) / 2) / nullif(sqrt((1 - ts / (c * c * c - c)) * n * (c - n) * (c + 1) / 12), 0), 0) z from rs join ti using (gene_id), nn)
"""


@query(_RANKS + "select grp, gene_id, n::bigint n, round(rank_sum, 3) rank_sum, round(z, 6) z from zs")
def rank_sums(spark, d):
    """Sparse rank sums, against ranks of the dense matrix."""
    return _r(_r(stats.rank_sums(roles.counts(spark, d), labelled(spark, d)), "z"), "rank_sum", digits=3)


@query(_RANKS + """, lg as (select x.cell_id, gene_id, ln(1 + "value" * 1e4 / sum("value") over (partition by cell_id)) v from x),
 i as (select o."cluster" grp, gene_id, sum(v) s, count(*) k from lg join obs o using (cell_id) group by all), w as (select gene_id, sum(s) ss, sum(k) kk from i group by 1),
 sz as (select "cluster" grp, count(*) n from obs group by 1)
 select sz.grp, w.gene_id, round(log2((exp(coalesce(s, 0) / n) - 1 + 1e-9) / (exp((ss - coalesce(s, 0)) / (c - n)) - 1 + 1e-9)), 6) logfc,
 round(coalesce(k, 0) / n, 6) pct_in, round((kk - coalesce(k, 0)) / (c - n), 6) pct_out
 from sz cross join w cross join nn left join i on i.grp = sz.grp and i.gene_id = w.gene_id""")
def marker_effects(spark, d):
    """Fold changes and shares of the marker table."""
    norm = matrix.normalise(roles.counts(spark, d))
    return _r(expression.rank_genes(norm, labelled(spark, d)).select("grp", "gene_id", "logfc", "pct_in", "pct_out"), "logfc", "pct_in", "pct_out")


@query()
def marker_table(spark, d):
    """The whole marker table with p-values, of which SQL has no normal tail."""
    return expression.rank_genes(matrix.normalise(roles.counts(spark, d)), labelled(spark, d))


@query("""m as (select row_id, dataset_id, pvals p from marker_gene where pvals is not null),
 r as (select *, row_number() over (partition by dataset_id order by p) k, count(*) over (partition by dataset_id) m from m),
 a as (select row_id, least(1.0, min(p * m / k) over (partition by dataset_id order by k desc rows between unbounded preceding and current row)) q from r)
 select row_id, round(q, 10) p_adj from marker_gene left join a using (row_id)""", prelude="with ")
def adjusted_p_values(spark, d):
    genes = table(spark, d, "marker_gene").select("row_id", "dataset_id", "pvals")
    return stats.benjamini_hochberg(genes, "pvals", "dataset_id").select("row_id", F.round("p_adj", 10).alias("p_adj"))


@query("""m as (select dataset_id, group_label, scores s, pct_nz_group::double p from marker_gene where scores is not null and not isnan(scores) and pct_nz_group is not null and not isnan(pct_nz_group) and group_label is not null),
 r as (select *, rank() over (partition by dataset_id, group_label order by s) + (count(*) over (partition by dataset_id, group_label, s) - 1) / 2.0 a,
  rank() over (partition by dataset_id, group_label order by p) + (count(*) over (partition by dataset_id, group_label, p) - 1) / 2.0 b from m)
 select dataset_id, group_label, count(*) n, round(case when stddev_pop(a) > 0 and stddev_pop(b) > 0 then corr(a, b) end, 6) + 0.0 rho from r group by 1, 2""", prelude="with ")
def rank_correlation(spark, d):
    real = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    genes = table(spark, d, "marker_gene").where(real("scores") & real("pct_nz_group") & F.col("group_label").isNotNull())
    return _r(stats.spearman(genes, "scores", "pct_nz_group", "dataset_id", "group_label"), "rho")


_PCS = """e as (select vec_id, label, unnest(range(len(embedding))) pc, unnest(embedding)::double v from embeddings),
 g as (select pc, label, count(*) n, sum(v) s, sum(v * v) q from e group by all),
 a as (select pc, coalesce((sum(s * s / n) - sum(s) * sum(s) / sum(n)) / nullif(sum(q) - sum(s) * sum(s) / sum(n), 0), 0) r2 from g group by 1)
"""


def _components(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("pc", "v")).withColumn("v", F.col("v").cast("double"))


@query(_PCS + "select pc::int pc, round(r2, 6) r2 from a", prelude="with ")
def variance_by_label(spark, d):
    """Share of each component's variance between labels."""
    return _r(stats.anova_r2(_components(spark, d), "label"), "r2")


@query(_PCS + """, s as (select r2, row_number() over (order by r2) i from a), t as (select 2 * sum(i * r2) / (count(*) * sum(r2)) - (count(*) + 1) / count(*) gini from s)
 select round(gini, 6) gini, case when gini <= 0.3 then 'batch' when gini >= 0.6 then 'biology' else 'ambiguous' end category from t""", prelude="with ")
def batch_diagnosis(spark, d):
    """Does a label act like a batch or like biology?"""
    g = stats.gini(stats.anova_r2(_components(spark, d), "label"), "r2")
    return g.select(F.round("gini", 6).alias("gini"), stats.batch_category(F.col("gini")).alias("category"))


@query("""c as (select "cluster" a, sample b, count(*)::double o from obs group by all), f as (select *, sum(o) over (partition by a) r, sum(o) over (partition by b) k, sum(o) over () n from c),
 e as (select sum(r0 * k0 / n0) z from (select distinct a, r r0 from f) cross join (select distinct b, k k0 from f) cross join (select max(n) n0 from f))
 select round(sqrt(greatest((max(n) * (sum(o * o / (r * k)) - 1)), 0) / (max(n) * (least(count(distinct a), count(distinct b)) - 1))), 6) v from f""")
def association(spark, d):
    return _r(stats.cramers_v(roles.cells(spark, d), "cluster", "sample"), "v")


@query("""c as (select leiden, lower(cell_type_std) l, count(*) n from obs_annotated where leiden is not null and cell_type_std is not null group by all)
 select round(sum(top) / sum(n), 6) purity from (select leiden, max(n) top, sum(n) n from c group by 1)""", prelude="with ")
def cluster_purity(spark, d):
    obs = table(spark, d, "obs_annotated").where("leiden is not null and cell_type_std is not null").withColumn("l", F.lower("cell_type_std"))
    return _r(stats.purity(obs, "leiden", "l"), "purity")


@query("""o as (select leiden a, dataset_id b from obs_annotated where leiden is not null and dataset_id is not null),
 s as (select sum(n * (n - 1) / 2) s from (select count(*)::double n from o group by a, b)), sa as (select sum(n * (n - 1) / 2) sa from (select count(*)::double n from o group by a)),
 sb as (select sum(n * (n - 1) / 2) sb from (select count(*)::double n from o group by b)), t as (select count(*)::double * (count(*) - 1) / 2 t from o)
 select round((s - sa * sb / t) / ((sa + sb) / 2 - sa * sb / t), 8) ari from s, sa, sb, t""", prelude="with ")
def rand_index(spark, d):
    obs = table(spark, d, "obs_annotated").where("leiden is not null and dataset_id is not null")
    return _r(stats.adjusted_rand(obs, "leiden", "dataset_id"), "ari", digits=8)


@query("""t as (select nation, stage, gene_id, sum("value")::double s from x join obs using (cell_id) group by all),
 z as (select nation, stage, count(*) n from obs group by all), u as (select * from z where n >= 5),
 k as (select nation from u group by 1 having count(*) >= 3 and sum(n) >= 50), m as (select g.nation, g.gene_id, u.stage, coalesce(s, 0) / u.n mean
  from (select distinct nation, gene_id from t) g join k using (nation) join u using (nation) left join t on t.nation = g.nation and t.gene_id = g.gene_id and t.stage = u.stage),
 r as (select *, rank() over (partition by nation, gene_id order by mean) + (count(*) over (partition by nation, gene_id, mean) - 1) / 2.0 a,
  rank() over (partition by nation, gene_id order by stage) b from m)
 select nation "type", gene_id, count(*) n, round(case when stddev_pop(a) > 0 then corr(a, b) end, 5) + 0.0 rho from r group by 1, 2""")
def stage_trends(spark, d):
    obs = roles.cells(spark, d).select("cell_id", F.col("nation").alias("type"), "stage")
    return _r(expression.stage_trends(roles.counts(spark, d), obs), "rho", digits=5)


@query("""s as (select distinct stage from obs) select stage "first", n "second" from (select stage, lead(stage) over (order by stage) n from s) where n is not null""")
def adjacent_stages(spark, d):
    return expression.adjacent_pairs(roles.cells(spark, d).select("stage").distinct(), "stage", "stage")


@query("""m as (select "cluster", condition, avg(price) metric from obs group by all)
 select a."cluster", a.condition "first", b.condition "second", round(a.metric, 4) m1, round(b.metric, 4) m2, round((b.metric + 1e-9) / (a.metric + 1e-9), 6) fold,
 round(log2((b.metric + 1e-9) / (a.metric + 1e-9)), 6) log2_fold from m a join m b on a."cluster" = b."cluster" and a.condition < b.condition""")
def compare_conditions(spark, d):
    means = roles.cells(spark, d).groupBy("cluster", "condition").agg(F.avg("price").alias("metric"))
    return _r(_r(expression.compare_groups(means, "cluster"), "m1", "m2", digits=4), "fold", "log2_fold")


@query("""s as (select cell_id, bool_or(gene_id in ('Brand#1', 'Brand#2')) f, bool_or(gene_id in ('Brand#3', 'Brand#4')) m from x where "value" > 0 group by 1)
 select case when f and m then 'Ambiguous' when f then 'Female' when m then 'Male' else 'Unknown' end sex, count(*) n from obs left join s using (cell_id) group by 1""")
def sex_labels(spark, d):
    cells = roles.cells(spark, d).select("cell_id")
    sex = expression.detect_sex(roles.counts(spark, d), cells, ["Brand#1", "Brand#2"], ["Brand#3", "Brand#4"])
    return sex.groupBy("sex").agg(F.count(F.lit(1)).alias("n"))


@query()
def differential_accessibility(spark, d):
    """Fold changes against a background drawn by hash."""
    return expression.differential_accessibility(roles.counts(spark, d), labelled(spark, d))


_TAIL = """g as (select dataset_id, count(distinct names)::int total, count(distinct names) filter (scores > 20)::int drawn from marker_gene where names is not null and not isnan(scores) group by 1),
 k as (select dataset_id, group_label, count(distinct names)::int marked, count(distinct names) filter (scores > 20)::int hits from marker_gene where names is not null and not isnan(scores) and group_label is not null group by 1, 2),
 t as (select dataset_id, group_label, hits, marked, drawn, total from k join g using (dataset_id)),
 e as (select *, unnest(range(greatest(hits, drawn + marked - total, 0), least(marked, drawn) + 1)) i from t)
"""


@query(_TAIL + """, p as (select dataset_id, group_label, sum(exp(lgamma(marked + 1) - lgamma(i + 1) - lgamma(marked - i + 1) + lgamma(total - marked + 1) - lgamma(drawn - i + 1)
  - lgamma(total - marked - drawn + i + 1) - lgamma(total + 1) + lgamma(drawn + 1) + lgamma(total - drawn + 1))) p from e group by 1, 2)
 select dataset_id, group_label, hits, marked, drawn, total, round(case when hits <= 0 then 1 else coalesce(least(1, p), 0) end, 7) p from t left join p using (dataset_id, group_label)""", prelude="with ")
def overrepresentation(spark, d):
    """Are a group's genes overrepresented among the high-scoring ones of its data set?"""
    rows = table(spark, d, "marker_gene").where("names is not null and scores is not null and not isnan(scores)")
    high = F.countDistinct(F.when(F.col("scores") > 20, F.col("names"))).cast("int")
    whole = rows.groupBy("dataset_id").agg(F.countDistinct("names").cast("int").alias("total"), high.alias("drawn"))
    groups = rows.where("group_label is not null").groupBy("dataset_id", "group_label").agg(F.countDistinct("names").cast("int").alias("marked"), high.alias("hits"))
    out = groups.join(whole, "dataset_id").withColumn("p", F.round(stats.hypergeometric_tail("hits", "marked", "drawn", "total"), 7))
    return out.select("dataset_id", "group_label", "hits", "marked", "drawn", "total", "p")


@query("""g as (select distinct gene_id from x), e as (select g.gene_id, coalesce(x."value", 0) v, price t from obs o cross join g left join x on x.cell_id = o.cell_id and x.gene_id = g.gene_id),
 r as (select gene_id, rank() over (partition by gene_id order by v) + (count(*) over (partition by gene_id, v) - 1) / 2.0 a, rank() over (partition by gene_id order by t) + (count(*) over (partition by gene_id, t) - 1) / 2.0 b from e)
 select gene_id, count(*) n, round(corr(a, b), 6) + 0.0 rho from r group by 1""")
def pseudotime_genes(spark, d):
    """Rank correlation of every gene with an order of the cells, zeros included."""
    order = roles.cells(spark, d).select("cell_id", F.col("price").alias("t"))
    return _r(stats.sparse_spearman(roles.counts(spark, d), order), "rho")
