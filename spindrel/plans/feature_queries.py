"""Queries on names of genes, thresholds, attachments, peaks, selections and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.operators import features, matrix, network
from spindrel.plans import roles
from spindrel.plans.book import Book
from spindrel.plans.matrix_queries import gene_sets
from spindrel.runtime import table

BOOK = Book(roles.SQL)
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- names

_GENES = """g as (select upper(trim(names)) gene, min(row_id) n from marker_gene where names is not null and trim(names) <> '' group by 1),
"""


def _genes(spark, d) -> DataFrame:
    m = table(spark, d, "marker_gene").where("names is not null and trim(names) <> ''")
    return m.groupBy(F.upper(F.trim("names")).alias("gene")).agg(F.min("row_id").alias("n"))


@query(_GENES + """h as (select case when gene like 'TXG%' then 'ENSDARG' || right(gene, 8) else gene end gene from g order by n limit 200), s as (select avg(regexp_matches(gene, '^ENS[A-Z]*G\\d{6,}')::int) share from h)
 select round(share, 6) share, case when share > 0.7 then 'ensembl' when share > 0 then 'mixed' else 'symbol' end kind from s""", prelude="with ")
def gene_id_type(spark, d):
    """Kind of the identifiers of the marker table, whose made-up ones stand for Ensembl's."""
    g = _genes(spark, d).withColumn("gene", F.when(F.col("gene").startswith("TXG"), F.concat(F.lit("ENSDARG"), F.expr("right(gene, 8)"))).otherwise(F.col("gene")))
    return _r(features.id_type(g), "share")


@query(_GENES + """m as (select gene gene_id, n, left(gene, 4) symbol from g where ascii(gene) % 3 > 0) select gene_id, n, symbol from m qualify row_number() over (partition by symbol order by n, gene_id) = 1""", prelude="with ")
def mapped_symbols(spark, d):
    """Genes with the symbol of a map, the first of each symbol."""
    g = _genes(spark, d).withColumnRenamed("gene", "gene_id")
    return features.with_symbols(g, g.where(F.ascii("gene_id") % 3 > 0).select("gene_id", F.substring("gene_id", 1, 4).alias("symbol")))


@query(_GENES + """pr as (select distinct gene source, case when ascii(gene) % 5 = 0 then left(gene, 5) else lower(gene) end target from g where n % 4 > 0), o as (select * from pr where source in (select source from pr group by 1 having count(*) = 1) and target in (select target from pr group by 1 having count(*) = 1))
 select gene, coalesce(target, gene) ortholog from g left join o on source = gene""", prelude="with ")
def ortholog_names(spark, d):
    g = _genes(spark, d)
    pairs = g.where("n % 4 > 0").select(F.col("gene").alias("source"), F.when(F.ascii("gene") % 5 == 0, F.substring("gene", 1, 5)).otherwise(F.lower("gene")).alias("target"))
    return features.orthologs(g.select("gene"), pairs)


@query("""r as (select row_id, dataset_id, group_label, upper(trim(names)) names from marker_gene where names is not null and trim(names) <> '') select row_id, names from r qualify row_number() over (partition by names order by row_id) = 1""", prelude="with ")
def normalised_symbols(spark, d):
    return features.normalised_symbols(table(spark, d, "marker_gene").select("row_id", "names"), "names", ["row_id"])


@query("""p as (select distinct regexp_replace(p_type, 'COPPER$', 'Lib_Human') nm from part) select nm set_name, regexp_replace(nm, '_Human$', '_Mouse') adapted from p""", prelude="with ")
def adapted_gene_sets(spark, d):
    p = table(spark, d, "part").select(F.regexp_replace("p_type", "COPPER$", "Lib_Human").alias("set_name")).distinct()
    return p.withColumn("adapted", features.gene_set_name(F.col("set_name"), "mouse"))


@query(_GENES + """c as (select count(*) filter (starts_with(gene, 'Mt-')) n from (select replace(gene, 'MIO', 'Mt-') gene from g)) select 'Mt-' as prefix, n from c""", prelude="with ")
def mitochondrial_prefix(spark, d):
    """The prefix in use, where genes of one syllable stand for the mitochondrial ones."""
    return features.mitochondrial_prefix(_genes(spark, d).select(F.replace("gene", F.lit("MIO"), F.lit("Mt-")).alias("gene")))


@query(_GENES + """a as (select gene, n, 0 source from g where gene < 'C'), b as (select gene, n, 1 from g where gene like '%7%'), u as (select * from a union all select * from b), o as (select * from u qualify row_number() over (partition by gene order by source, n) = 1)
 select gene, source, rank from (select gene, source, row_number() over (order by source, n, gene) as rank from o) where rank <= 700""", prelude="with ")
def merged_gene_lists(spark, d):
    """Two lists of genes made one, the first wins, cut at the length asked for."""
    g = _genes(spark, d)
    return features.merged_lists([g.where("gene < 'C'"), g.where("gene like '%7%'")], 700).withColumn("rank", F.col("rank").cast("bigint"))


@query("""s as (select distinct o."cluster" sample, gene_id gene from x join obs o using (cell_id)) select gene from s group by 1 having count(distinct sample) = (select count(distinct sample) from s)""")
def common_genes(spark, d):
    x = roles.counts(spark, d).join(roles.cells(spark, d).select("cell_id", F.col("cluster").alias("sample")), "cell_id")
    return features.common_genes(x.select("sample", F.col("gene_id").alias("gene")).distinct())


@query("""s as (select o."cluster" sample, list(distinct gene_id order by gene_id) l from x join obs o using (cell_id) group by 1) select count(distinct l) <= 1 same, count(*) n_samples from s""")
def same_gene_lists(spark, d):
    x = roles.counts(spark, d).join(roles.cells(spark, d).select("cell_id", F.col("cluster").alias("sample")), "cell_id").select("sample", F.col("gene_id").alias("gene")).distinct()
    return features.same_genes(x.withColumn("n", F.lit(0)))


@query("""a as (select distinct upper(names) gene from marker_gene where dataset_id = 'FXD000000' and names is not null), b as (select distinct upper(names) gene from marker_gene where dataset_id <> 'FXD000000' and names is not null), z as (select (select count(*) from a) n_a, (select count(*) from b) n_b, (select count(*) from a semi join b using (gene)) n_both)
 select n_a, n_b, n_both, round(n_both / least(n_a, n_b), 6) share, n_both / least(n_a, n_b) >= 0.5 enough from z""", prelude="with ")
def gene_overlap_gate(spark, d):
    m = table(spark, d, "marker_gene").where("names is not null").select("dataset_id", F.upper("names").alias("gene"))
    return _r(features.aligned_genes(m.where("dataset_id = 'FXD000000'"), m.where("dataset_id <> 'FXD000000'")), "share")


# --- cells


@query("""t as (select cell_id, sum("value") total from x group by 1) select count(*) n, median(total) median, least(100.0, median(total) * 0.8) low from t""")
def hard_lower_limit(spark, d):
    return features.hard_limit(matrix.cell_metrics(roles.counts(spark, d), *gene_sets(), top=2), "total", 100.0)


@query("""m as (select cell_id, count(*) n_genes, sum("value") total, sum(case when gene_id = 'Brand#1' then "value" else 0 end) * 100 / sum("value") mt from x group by 1), s as (select sample, m.* from m join obs using (cell_id)),
 a as (select sample, median(mt) mt, median(n_genes) g, avg(total) av, stddev_samp(total) sd from s group by 1), f as (select sample, avg((abs(total - av) > 3 * sd)::int) far from s join a using (sample) group by 1)
 select sample, array_to_string(list_filter([case when mt > 1 then 'mitochondrial' end, case when g < 500 then 'few_genes' end, case when far > 0.01 then 'outliers' end], lambda q: q is not null), ',') findings from a join f using (sample)""")
def qc_suggestions(spark, d):
    m = matrix.cell_metrics(roles.counts(spark, d), *gene_sets(), top=2).join(roles.cells(spark, d).select("cell_id", "sample"), "cell_id")
    return features.suggestions(m, mt_high=1.0)


@query("""l as (select cell_id, min(cell_type_std) cell_type from obs_annotated where cell_id is not null and cell_type_std is not null group by 1), f as (select row_id, cell_id from obs_annotated where row_id % 2 = 0)
 select coalesce(cell_type, 'unassigned') cell_type, count(*) n from f left join l using (cell_id) group by 1""", prelude="with ")
def attached_labels(spark, d):
    """Labels of one delivery put on the barcodes of all cells of another."""
    o = table(spark, d, "obs_annotated")
    labels = o.where("cell_id is not null and cell_type_std is not null").select("cell_id", F.col("cell_type_std").alias("cell_type"))
    out = features.attached(o.where("row_id % 2 = 0").select("row_id", "cell_id"), labels, "cell_id", ["cell_type"])
    return out.groupBy("cell_type").agg(F.count(F.lit(1)).alias("n"))


@query("""o as (select row_id from obs_annotated where batch is not null and leiden is not null and sample_id is not null) select count(*) n, sum(row_id)::bigint ids from o""", prelude="with ")
def batched_cells(spark, d):
    out = features.with_batches(table(spark, d, "obs_annotated").select("row_id", "batch", "leiden", "sample_id"), ["batch", "leiden", "sample_id"])
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"))


@query("""a as (select cell_id from obs_annotated where dataset_id = 'FXD000000'), b as (select cell_id from obs_annotated where dataset_id <> 'FXD000000') select count(distinct cell_id) n_common from a semi join b using (cell_id)""", prelude="with ")
def paired_barcodes(spark, d):
    """Barcodes that two assays have in common."""
    o = table(spark, d, "obs_annotated")
    return o.where("dataset_id = 'FXD000000'").join(o.where("dataset_id <> 'FXD000000'"), "cell_id", "left_semi").agg(F.count_distinct("cell_id").alias("n_common"))


@query("""m as (select sample_id, max(grp) stage from sample_entry where sample_id is not null group by 1) select stage, count(*) n from obs_annotated left join m using (sample_id) group by 1""", prelude="with ")
def mapped_stages(spark, d):
    """Cells of each stage that a map of samples gives; null for samples outside it."""
    m = table(spark, d, "sample_entry").where("sample_id is not null").groupBy("sample_id").agg(F.max("grp").alias("stage"))
    return table(spark, d, "obs_annotated").join(m, "sample_id", "left").groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query("""b as (select sample || condition sample, gene_id gene, sum("value")::double v from x join obs using (cell_id) group by 1, 2), l as (select sample, sum(v) lib from b group by 1), md as (select median(lib) mid from l), sm as (select distinct sample, right(sample, 1) grp from b), nd as (select least(min(n), 3) need from (select grp, count(*) n from sm group by 1)),
 p as (select gene, count(*) filter (v / lib * 1e6 >= 500 / mid * 1e6) k, sum(v) total from b join l using (sample), md group by 1) select gene, total from p, nd where k >= need and total >= 1000""")
def genes_by_expression(spark, d):
    """Genes that enough samples express."""
    x = roles.counts(spark, d).join(roles.cells(spark, d).select("cell_id", F.concat("sample", "condition").alias("sample")), "cell_id")
    x = x.groupBy("sample", F.col("gene_id").alias("gene")).agg(F.sum("value").cast("double").alias("value"))
    return features.expressed_by_group(x, x.select("sample").distinct().withColumn("grp", F.expr("right(sample, 1)")), 500, 3, 1000)


_SCORE = """n as (select count(*) c from obs), mo as (select gene_id, sum("value") / any_value(c) mean from x, n group by 1), b as (select gene_id, ntile(5) over (order by mean, gene_id) bin, gene_id in ('Brand#1', 'Brand#2') s, gene_id in ('Brand#3', 'Brand#4') g from mo),
 cs as (select cell_id, coalesce(sum("value") filter (s) / 2, 0) - coalesce(sum("value") filter (not s and bin in (select bin from b where s)) / (select count(*) from b where not s and bin in (select bin from b where s)), 0) v from x join b using (gene_id) where s or bin in (select bin from b where s) group by 1),
 cg as (select cell_id, coalesce(sum("value") filter (g) / 2, 0) - coalesce(sum("value") filter (not g and bin in (select bin from b where g)) / (select count(*) from b where not g and bin in (select bin from b where g)), 0) v from x join b using (gene_id) where g or bin in (select bin from b where g) group by 1)
"""


@query(_SCORE + """, j as (select cell_id, round(coalesce(cs.v, 0), 6) s, round(coalesce(cg.v, 0), 6) g from cs full join cg using (cell_id)) select case when s <= 0 and g <= 0 then 'G1' when s >= g then 'S' else 'G2M' end phase, count(*) n, round(sum(s), 3) s, round(sum(g), 3) g2m from j group by 1""")
def cell_cycle_phases(spark, d):
    """Cells in each phase of the cycle, by scores of two gene sets."""
    n = roles.cells(spark, d).count()
    out = features.cycle_phase(roles.counts(spark, d), n, ["Brand#1", "Brand#2"], ["Brand#3", "Brand#4"], 5)
    out = _r(out, "s", "g2m")
    phase = F.when((F.col("s") <= 0) & (F.col("g2m") <= 0), "G1").when(F.col("s") >= F.col("g2m"), "S").otherwise("G2M")
    return _r(out.groupBy(phase.alias("phase")).agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.sum("g2m").alias("g2m")), "s", "g2m", digits=3)


@query("""f as (select min(stage) fs from obs), l as (select cell_id, case when "cluster" = '1-URGENT' and stage = fs then 1 when "cluster" = '1-URGENT' then 2 when stage = fs then 3 else 4 end lv from obs, f) select cell_id, lv as level from l where lv = (select min(lv) from l)""")
def trajectory_roots(spark, d):
    return features.root_cells(roles.cells(spark, d).select("cell_id", F.col("cluster").alias("type"), "stage"), ["1-URGENT"])


@query("""z as (select "cluster" "type", condition, count(*) n from obs group by 1, 2 having count(*) >= 10), w as (select condition, count(*) nc from obs group by 1), m as (select o."cluster" "type", condition, sum("value")::double s from x join obs o using (cell_id) where gene_id in ('Brand#1', 'Brand#2', 'Brand#3') group by 1, 2)
 select "type", condition, n, round(coalesce(s, 0) / n / 3, 6) set_mean, round(n * 100 / nc, 6) pct_cells from z join w using (condition) left join m using ("type", condition)""")
def condition_metrics(spark, d):
    cells = roles.cells(spark, d).select("cell_id", F.col("cluster").alias("type"), "condition")
    return _r(features.condition_metrics(roles.counts(spark, d), cells, ["Brand#1", "Brand#2", "Brand#3"]), "set_mean", "pct_cells")


_PAIRS = """z as (select "cluster" "type", stage, count(*) n from obs group by 1, 2), p as (select "type", stage f, lead(stage) over w s, n, lead(n) over w m from z window w as (partition by "type" order by stage)),
 q as (select * from p where s is not null and n + m >= 20 and least(n, m) >= 10), dn as (select q."type", f, s, n, m, o.cell_id, o.stage = f a, g.gene_id, coalesce(ln(1 + x."value"), 0) v from q join obs o on o."cluster" = q."type" and o.stage in (f, s) cross join (select distinct gene_id from x) g left join x on x.cell_id = o.cell_id and x.gene_id = g.gene_id),
 rk as (select *, rank() over (partition by "type", f, gene_id order by v) + (count(*) over (partition by "type", f, gene_id, v) - 1) / 2.0 r from dn), ti as (select "type", f, gene_id, sum(t::double * t * t - t) ts from (select "type", f, gene_id, v, count(*) t from dn group by all) group by all),
 ag as (select "type", f, s, gene_id, any_value(n) n, any_value(m) m, sum(r) filter (a) ra, sum(v) filter (a) / any_value(n) ma, sum(v) filter (not a) / any_value(m) mb, max(v) mx from rk group by all),
 zs as (select ag.*, coalesce((ra - n * (n + m + 1) / 2.0) / nullif(sqrt((1 - ts / ((n + m)::double ** 3 - (n + m))) * n::double * m * (n + m + 1) / 12), 0), 0) zz from ag join ti using ("type", f, gene_id) where mx > 0)
"""


@query(_PAIRS + """ select "type", f "first", s "second", gene_id, round(zz, 5) + 0.0 z, round(log2((exp(ma) - 1 + 1e-9) / (exp(mb) - 1 + 1e-9)), 5) + 0.0 logfc from zs""")
def pairwise_stage_effects(spark, d):
    """Tests between neighbouring stages of each type."""
    x = roles.counts(spark, d).withColumn("value", F.log1p("value"))
    out = features.pairwise_effects(x, roles.cells(spark, d).select("cell_id", F.col("cluster").alias("type"), "stage"))
    return _r(out.select("type", "first", "second", "gene_id", "z", "logfc"), "z", "logfc", digits=5)


@query("""t as (select o."cluster" a, gene_id gene, avg("value") m from x join obs o using (cell_id) group by 1, 2), p as (select q.a, r.a b, q.gene, q.m - r.m logfc, (ascii(q.gene) + length(q.a) + length(r.a)) % 10 / 100 p_adj from t q join t r on r.gene = q.gene and r.a <> q.a),
 w as (select a, gene from p where p_adj < 0.09 and logfc >= 0.05 group by 1, 2 having count(distinct b) = (select count(distinct a) - 1 from t)) select grp, coalesce(n, 0) n_genes from (select distinct "cluster" grp from obs) left join (select a grp, count(*) n from w group by 1) using (grp)""")
def always_significant_genes(spark, d):
    """Genes of each group that stand out against every other group."""
    t = roles.counts(spark, d).join(roles.cells(spark, d).select("cell_id", F.col("cluster").alias("a")), "cell_id").groupBy("a", F.col("gene_id").alias("gene")).agg(F.avg("value").alias("m"))
    other = t.select(F.col("a").alias("b"), "gene", F.col("m").alias("mb"))
    p = (F.ascii("gene") + F.length("a") + F.length("b")) % 10 / 100
    tests = t.join(other, "gene").where("a <> b").select("a", "b", "gene", (F.col("m") - F.col("mb")).alias("logfc"), p.alias("p_adj"))
    return features.always_significant(tests, roles.cells(spark, d).select(F.col("cluster").alias("grp")), 0.09, 0.05)


# --- selections


@query("""s as (select o."cluster" grp, gene_id gene, sum("value") / any_value(c) mean from x join obs o using (cell_id) join (select "cluster" g, count(*) c from obs group by 1) z on z.g = o."cluster" group by 1, 2), pr(ligand, receptor) as (values ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#4')),
 i as (select a.grp source, b.grp target, ligand, receptor, round(1 / (a.mean * b.mean), 9) magnitude_rank from pr join s a on a.gene = ligand join s b on b.gene = receptor)
 select source, target, ligand, receptor, magnitude_rank, source || ' -> ' || target || ': ' || ligand || '-' || receptor interaction from i order by magnitude_rank, interaction limit 12""")
def top_interactions(spark, d):
    obs = roles.cells(spark, d).select("cell_id", F.col("cluster").alias("grp"))
    n = obs.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    s = roles.counts(spark, d).join(obs, "cell_id").groupBy("grp", F.col("gene_id").alias("gene")).agg(F.sum("value").alias("s")).join(n, "grp")
    s = s.select("grp", "gene", (F.col("s") / F.col("n")).alias("mean"), F.lit(1.0).alias("prop"))
    out = network.interactions(s, spark.sql("select * from values ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#4') as t(ligand, receptor)"))
    out = out.select("source", "target", "ligand", "receptor", F.round(1 / F.col("lr_prod"), 9).alias("magnitude_rank"))
    return features.top_interactions(out, "magnitude_rank", 12)


@query("""r as (select s_suppkey source, round(s_acctbal, 2) variance, (s_suppkey * 37) % 101 relevance from supplier), k as (select *, row_number() over (order by variance desc, source) v, row_number() over (order by relevance desc, source) r2 from r) select source, rank from (select source, row_number() over (order by v + r2, source) as rank from k) where rank <= 20""", prelude="with ")
def variable_regulators(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source"), F.round("s_acctbal", 2).alias("variance"), ((F.col("s_suppkey") * 37) % 101).alias("relevance"))
    return features.variable_sources(s, 20, by_rank=True).withColumn("rank", F.col("rank").cast("bigint"))


@query("""y(nm, sp) as (values ('mouse', 'mus'), ('mus musculus', 'mus'), ('human', 'homo'), ('homo sapiens', 'homo')), e as (select sample_id, species from sample_entry where species is not null) select sample_id, species, count(*) n from e left join y on nm = lower(species) where coalesce(sp, lower(species)) = 'mus' group by all""", prelude="with ")
def samples_of_species(spark, d):
    names = spark.sql("select * from values ('mouse', 'mus'), ('mus musculus', 'mus'), ('human', 'homo'), ('homo sapiens', 'homo') as t(name, species)")
    out = features.species_matches(F.col("species"), F.lit("Mus musculus"), names, table(spark, d, "sample_entry").where("species is not null").select("sample_id", "species"))
    return out.groupBy("sample_id", "species").agg(F.count(F.lit(1)).alias("n"))


# --- fragments

_FRAGMENTS = """fr as (select event_id id, (user_id % 50)::varchar cell_id, (user_id % 10)::varchar chrom, epoch(date_trunc('second', ts))::bigint "start", epoch(date_trunc('second', ts))::bigint + 60 + floor("value" * 20)::bigint "end", event_type t from events),
"""


def _fragments(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    mod = lambda n: (F.col("user_id") % n).cast("string")
    return e.select(F.col("event_id").alias("id"), mod(50).alias("cell_id"), mod(10).alias("chrom"), at.alias("start"), (at + 60 + F.floor(F.col("value") * 20)).alias("end"), F.col("event_type").alias("t"))


@query(_FRAGMENTS + """s as (select distinct chrom, "start" site from fr where t = 'purchase'), c as (select cell_id, chrom, unnest(["start", "end" - 1]) pos from fr where t <> 'purchase'), n as (select cell_id, abs(pos - site) dd from c join s using (chrom) where abs(pos - site) <= 20000),
 p as (select cell_id, count(*) filter (dd <= 2000) i, count(*) filter (dd > 18000) o from n group by 1) select cell_id, i as "inner", o as "outer", round(i / 4001.0 / ((o + 1) / 4000.0), 6) tss from p""", prelude="with ")
def tss_enrichment(spark, d):
    """Insertions around sites against their flanks, per cell."""
    f = _fragments(spark, d)
    sites = f.where("t = 'purchase'").select("chrom", F.col("start").alias("site"))
    return _r(features.tss_enrichment(f.where("t <> 'purchase'"), sites, 20_000, 2_000), "tss")


@query(_FRAGMENTS + """p as (select chrom, "start" - 1800 s, "start" + 1800 e from fr where t = 'purchase'), h as (select distinct id from fr join p using (chrom) where t <> 'purchase' and "start" < e and s < "end") select cell_id, count(*) n, count(h.id) n_in, round(count(h.id) / count(*), 6) frip from fr left join h using (id) where t <> 'purchase' group by 1""", prelude="with ")
def fragments_in_peaks(spark, d):
    f = _fragments(spark, d)
    peaks = f.where("t = 'purchase'").select("id", "chrom", (F.col("start") - 1800).alias("start"), (F.col("start") + 1800).alias("end"))
    return _r(features.share_in_peaks(f.where("t <> 'purchase'"), peaks, 3600), "frip")


@query(_FRAGMENTS + """b as (select chrom, floor(("start" + "end") / 2 / 86400)::bigint bin, count(*) n from fr group by 1, 2), r as (select chrom, sum(n) / (max(bin) - min(bin) + 1) m from b group by 1), k as (select *, (n * ln(n / m) - n + m) / ln(10) score from b join r using (chrom) where n > m)
 select chrom, bin * 86400 "start", (bin + 1) * 86400 "end", n, round(score, 6) score from k where score >= 1""", prelude="with ")
def binned_peaks(spark, d):
    """Windows with more fragments than their chromosome's rate explains."""
    return _r(features.binned_peaks(_fragments(spark, d), 86_400, 1.0), "score")


@query(_FRAGMENTS + """n as (select cell_id, count(*) n, (sum(id) % 10)::double tss from fr group by 1) select cell_id, n from n where n between 100 and 220 and tss >= 3""", prelude="with ")
def kept_barcodes(spark, d):
    per = _fragments(spark, d).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"), (F.sum("id") % 10).cast("double").alias("tss"))
    return features.kept_barcodes(per, 100, 220, 3.0).select("cell_id", "n")


# --- files


@query(r"""f as (select regexp_extract(path, '^(.*?)/?[^/]*$', 1) folder, regexp_extract(lower(path), '[^/]*$') nm from artifact where path is not null),
 k as (select folder, count(*) n, bool_or(regexp_matches(nm, 'matrix\.mtx(\.gz)?$')) m, bool_or(regexp_matches(nm, 'barcodes\.tsv(\.gz)?$')) b, bool_or(regexp_matches(nm, '(features|genes)\.tsv(\.gz)?$')) g, bool_or(regexp_matches(nm, 'peaks\.bed(\.gz)?$')) p, bool_or(regexp_matches(nm, 'fragments\.tsv(\.gz)?$')) f,
  bool_or(regexp_matches(nm, '\.h5$')) h, count(*) filter (regexp_matches(nm, '\.(csv|tsv|txt)(\.gz)?$')) t from f group by 1)
 select folder, case when m and b and p then 'peaks' when m and b and g then 'mtx' when f then 'fragments' when h then 'h5' when t >= 3 then 'tables' else 'other' end kind, n from k""", prelude="with ")
def folder_kinds(spark, d):
    """What the files of each folder make together."""
    return features.folder_kinds(table(spark, d, "artifact").where("path is not null").select("path"))


@query(r"""f as (select path, regexp_extract(path, '[^/]*$') nm from artifact where path is not null), s as (select path, regexp_replace(nm, '(?i)[._-]?(matrix|barcodes|features|genes|counts|filtered|raw)?\.(mtx|tsv|csv|txt|h5|h5ad)(\.gz)?$', '') h from f)
 select case when h <> '' then h else regexp_extract(path, '([^/]+)/[^/]*$', 1) end sample, count(*) n from s group by 1""", prelude="with ")
def file_samples(spark, d):
    """Files of each sample, by their names."""
    return table(spark, d, "artifact").where("path is not null").groupBy(features.sample_of(F.col("path")).alias("sample")).agg(F.count(F.lit(1)).alias("n"))


@query("""p as (select lower(title) t, journal from paper_entry where title is not null), m as (select array_to_string(list_filter([case when contains(t, 'atac') or contains(t, 'chromatin accessibility') then 'atac' end, case when contains(t, 'visium') or contains(t, 'spatial') then 'spatial' end, case when contains(t, 'bulk') then 'bulk' end,
  case when contains(t, 'rna') or contains(t, 'expression') or contains(t, 'transcript') then 'rna' end], lambda q: q is not null), ',') k, case when contains(t, 'retina') then 'retina' when contains(t, 'brain') then 'brain' when contains(t, 'heart') then 'heart' when contains(t, 'liver') then 'liver' when contains(t, 'lung') then 'lung' when contains(t, 'kidney') then 'kidney' end tissue from p)
 select case when k = '' then 'rna' else k end modality, tissue, count(*) n from m group by 1, 2""", prelude="with ")
def paper_modalities(spark, d):
    """Assays and tissues that titles name."""
    p = table(spark, d, "paper_entry").where("title is not null")
    return p.groupBy(features.modalities(F.col("title")).alias("modality"), features.tissue_of(F.col("title")).alias("tissue")).agg(F.count(F.lit(1)).alias("n"))


@query("""v as (select event_type sample, case when event_type in ('click', 'view') then floor("value") when event_type = 'purchase' then "value" * 100 else "value" / 100 end v from events), k as (select sample, bool_and(v = floor(v)) w, median(v) filter (v > 0) m from v group by 1) select sample, case when w then 'raw' when m > 1 then 'cpm' else 'tpm' end kind from k""", prelude="with ")
def value_kinds(spark, d):
    """Raw counts or scaled values, by the numbers themselves."""
    e = table(spark, d, "events")
    value = F.when(F.col("event_type").isin("click", "view"), F.floor("value").cast("double")).when(F.col("event_type") == "purchase", F.col("value") * 100).otherwise(F.col("value") / 100)
    return features.value_kind(e.select(F.col("event_type").alias("sample"), value.alias("value")))


@query("""s as (select distinct lower(trim(species)) sp from sample_entry where species is not null) select sp species, case sp when 'human' then 'hg38' when 'mouse' then 'mm10' when 'zebrafish' then 'danRer11' end genome from s""", prelude="with ")
def species_genomes(spark, d):
    s = table(spark, d, "sample_entry").where("species is not null").select(F.lower(F.trim("species")).alias("species")).distinct()
    return s.withColumn("genome", features.genome_of(F.col("species")))
