"""Queries that annotate the groups of the marker table with a knowledge base made of the table itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.operators import annotation, knowledge
from spindrel.plans.book import Book
from spindrel.runtime import checkpoint, strip, table

#: Groups as clusters; groups whose labels begin alike as types, data sets as sources; types of equal last digit have one parent.
SQL = """with recursive m0 as (select dataset_id || '|' || group_label "cluster", dataset_id ds, 'T' || (ascii(group_label) % 20) "type", upper(trim(names)) gene, logfoldchanges lfc, pct_nz_group::double pct from marker_gene
  where dataset_id is not null and group_label is not null and group_label <> '' and names is not null and trim(names) <> '' and logfoldchanges is not null and not isnan(logfoldchanges)),
mk as materialized (select "cluster", gene, max(lfc) lfc from m0 group by all),
kb as materialized (select "type", gene, count(distinct ds) n from m0 where lfc > 0 group by all having count(distinct ds) >= 2),
ng as (select "type", gene from m0 group by all having max(lfc) < 0),
fr as (select "cluster", gene, max(pct) pct from m0 where pct is not null and not isnan(pct) group by all),
rk as (select *, row_number() over (partition by "cluster" order by lfc desc, gene) k from mk),
noise as (select distinct gene from mk where starts_with(gene, 'MT-') or regexp_matches(gene, '^(RPL|RPS|MRPL|MRPS)') or regexp_matches(gene, '^(LINC\\d|AC\\d|AL\\d|AP\\d|BX\\d|FAM\\d+[A-Z]|C\\d+orf|RP\\d+-|CTC-|CTD-|RP11-|XXyac-|LLNLF-|WI2-|XXbac-)')),
cl as (select "cluster", gene, row_number() over (partition by "cluster" order by lfc desc, gene) k from mk anti join noise using (gene)),
bg as (select greatest(count(distinct gene), 1) n_bg from kb),
w0 as (select "cluster", count(*) filter (k <= 20 and h) h20, count(*) filter (k <= 50 and h) h50, count(*) filter (k <= 100 and h) h100, count(*) filter (k <= 200 and h) h200,
  count(*) filter (k <= 20) n20, count(*) filter (k <= 50) n50, count(*) filter (k <= 100) n100, count(*) filter (k <= 200) n200
  from (select cl.*, gene in (select gene from kb) h from cl) group by 1),
w1 as (select *, h20 / n_bg < 0.05 and h50 > h20 c from w0, bg), w2 as (select *, case when c then 50 else 20 end w, case when c then h50 else h20 end h, case when c then n50 else n20 end n from w1),
w3 as (select *, h / n_bg < 0.05 and h100 > h c2 from w2), w4 as (select * replace (case when c2 then 100 else w end as w, case when c2 then h100 else h end as h, case when c2 then n100 else n end as n) from w3),
w5 as (select *, h / n_bg < 0.05 and h200 > h c3 from w4), wn as materialized (select "cluster", case when c3 then 200 else w end w, case when c3 then h200 else h end h, case when c3 then n200 else n end n, n_bg from w5),
ty as (select "type", count(*) n_type, max(n) <= 1 single from kb group by 1),
ht as (select "cluster", "type", count(*) hits, count(*) filter (k <= 20) h20, max(case when kb.n >= 5 then 4 when kb.n >= 3 then 3 when kb.n >= 2 then 2 else 1 end) best,
  round_even(sum(case when kb.n >= 5 then 3.0 when kb.n >= 3 then 2.0 when kb.n >= 2 then 1.5 else 1.0 end * case when single then 0.5 else 1.0 end), 0)::bigint aw,
  any_value(w) w, any_value(h) h, any_value(wn.n) n, any_value(n_bg) n_bg, any_value(n_type) n_type from cl join wn using ("cluster") join kb using (gene) join ty using ("type") where k <= w group by 1, 2),
tb as (select "cluster", "type", hits a, 'raw' v, n_type, hits + (h - hits) drawn, greatest(n_bg, hits + (n_type - hits) + (h - hits) + 1) total from ht
  union all select "cluster", "type", aw, 'w', n_type, aw + (h - hits), greatest(n_bg, aw + (n_type - aw) + (h - hits) + 1) from ht where aw > hits and aw <= n_type),
tt as (select *, unnest(range(greatest(a, drawn + n_type - total), least(n_type, drawn) + 1)) i from tb),
pv as (select "cluster", "type", v, least(1.0::double, sum(exp(lgamma(n_type + 1) - lgamma(i + 1) - lgamma(n_type - i + 1) + lgamma(total - n_type + 1) - lgamma(drawn - i + 1) - lgamma(total - n_type - drawn + i + 1)
  - lgamma(total + 1) + lgamma(drawn + 1) + lgamma(total - drawn + 1)))) p from tt group by 1, 2, 3),
sp as (select ht.*, r.p pr, x.p pw, coalesce(x.p < 0.999, false) uw, hits / sqrt(n * n_type) cs, coalesce(nn.c >= 2, false) pen from ht left join pv r on r."cluster" = ht."cluster" and r."type" = ht."type" and r.v = 'raw'
  left join pv x on x."cluster" = ht."cluster" and x."type" = ht."type" and x.v = 'w'
  left join (select "cluster", "type", count(*) c from rk join ng using (gene) where k <= 10 group by 1, 2) nn on nn."cluster" = ht."cluster" and nn."type" = ht."type"),
sc as materialized (select *, case when uw then pw else pr end p, greatest(1 - case when uw then pw else pr end, cs) * case when n_type > 5 then 1.0 when n_type >= 3 then 0.8 else 0.5 end * case when pen then 0.5 else 1.0 end raw_score from sp),
s as materialized (select "cluster", "type", round(raw_score, 6) score from sc),
par as (select distinct "type", 'T' || (right("type", 1)::int % 5) parent from ty),
lq as (select "cluster", count(*) filter (starts_with(gene, 'MT')) n_mt, count(*) filter (starts_with(gene, 'RPL')) n_ribo from rk where k <= 20 group by 1),
"""
BOOK = Book(SQL)
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def _rows(spark, d) -> DataFrame:
    m = table(spark, d, "marker_gene")
    gene = F.upper(strip("names"))
    rows = m.where("dataset_id is not null and group_label is not null and group_label <> '' and names is not null and logfoldchanges is not null and not isnan(logfoldchanges)")
    return rows.where(F.length(gene) > 0).select(
        F.concat_ws("|", "dataset_id", "group_label").alias("cluster"), F.col("dataset_id").alias("ds"), F.concat(F.lit("T"), (F.ascii("group_label") % 20).cast("string")).alias("type"),
        gene.alias("gene"), F.col("logfoldchanges").alias("lfc"), F.col("pct_nz_group").cast("double").alias("pct"),
    )


def markers(spark, d) -> DataFrame:
    return _rows(spark, d).groupBy("cluster", "gene").agg(F.max("lfc").alias("logfc"))


def kb(spark, d) -> DataFrame:
    return _rows(spark, d).where("lfc > 0").groupBy("type", "gene").agg(F.countDistinct("ds").alias("n_sources")).where("n_sources >= 2")


def negatives(spark, d) -> DataFrame:
    return _rows(spark, d).groupBy("type", "gene").agg(F.max("lfc").alias("m")).where("m < 0").select("type", "gene")


def fractions(spark, d) -> DataFrame:
    return _rows(spark, d).where("pct is not null and not isnan(pct)").groupBy("cluster", "gene").agg(F.max("pct").alias("pct"))


def scores(spark, d) -> DataFrame:
    return checkpoint(annotation.score_clusters(checkpoint(markers(spark, d)), checkpoint(kb(spark, d)), negatives(spark, d)))


def rounded(spark, d) -> DataFrame:
    return scores(spark, d).select("cluster", "type", F.round("score", 6).alias("score"))


def parents(spark, d) -> DataFrame:
    """The parent of each type; those that are their own are major types."""
    types = kb(spark, d).select("type").distinct()
    return types.select("type", F.concat(F.lit("T"), (F.substring("type", -1, 1).cast("int") % 5).cast("string")).alias("parent"))


@query("""z as (select 1) select "cluster", "type", hits, n_type, w as "window", round(p, 6) p, round(raw_score, 6) score,
 case when 1 - p >= cs then case when uw then 'hypergeometric_weighted' else 'hypergeometric' end else 'cosine' end "method", pen penalty, case best when 4 then 'gold' when 3 then 'high' when 2 then 'medium' else 'low' end consensus,
 case when h20 < 2 and w > 20 then 'window_padding' when h20 = 0 then 'zero_evidence' when h20 = 1 then 'single_marker' when best >= 3 then 'multi_marker' else 'weak_multi' end evidence from sc""")
def annotation_scores(spark, d):
    """Scores of all groups for all types of which they have a marker."""
    return _r(scores(spark, d), "p", "score")


@query("""z as (select 1) select "cluster", w as "window", h hits_window, n n_window, n_bg background from wn""")
def adaptive_windows(spark, d):
    return annotation.windows(markers(spark, d), kb(spark, d))


@query("""z as (select 1) select "cluster", "type", score from s qualify row_number() over (partition by "cluster" order by score desc, "type") = 1 and score >= 0.25""")
def best_cluster_types(spark, d):
    return annotation.best_types(rounded(spark, d))


@query("""z as (select 1) select "cluster", n_mt, n_ribo, case when n_mt >= 3 then 'mito_high' when n_ribo >= 5 then 'ribo_high' when n_mt + n_ribo >= 6 then 'mito_ribo_mixed' end reason from
 (select "cluster", count(*) filter (starts_with(gene, 'MT-')) n_mt, count(*) filter (regexp_matches(gene, '^(RPL|RPS|MRPL|MRPS)')) n_ribo from (select "cluster", case when gene like 'MI%' then 'MT-' || gene when gene like 'R%' then 'RPL' || gene else gene end gene, k from rk) where k <= 20 group by 1)""")
def low_quality_clusters(spark, d):
    """Groups led by genes in the roles of mitochondrial and ribosomal ones; the places are those of the genes' own names."""
    m = annotation.ranked(markers(spark, d)).where("k <= 20")
    role = F.when(F.col("gene").startswith("MI"), F.concat(F.lit("MT-"), "gene")).when(F.col("gene").startswith("R"), F.concat(F.lit("RPL"), "gene")).otherwise(F.col("gene"))
    return annotation.low_quality(m.withColumn("gene", role))


@query("""z as (select 1) select gene, n_clusters from (select gene, count(*) n_clusters from mk anti join noise using (gene) group by 1)""")
def informative_genes(spark, d):
    """Genes that are no noise and the groups that have them."""
    return markers(spark, d).where(~annotation.is_noise(F.col("gene"))).groupBy("gene").agg(F.count(F.lit(1)).alias("n_clusters"))


@query("""l2 as (select "cluster", "type" l2, score sc2 from s join par using ("type") where "type" = parent qualify row_number() over (partition by "cluster" order by score desc, "type") = 1),
 pv2 as (select "type", gene, n from kb where gene in (select gene from kb group by 1 having count(*) <= 2)),
 ok as (select a."cluster", a."type" l3, a.score from s a join par p on p."type" = a."type" and p.parent <> p."type" join l2 b on b."cluster" = a."cluster" and b.l2 = p.parent where a.score >= sc2 - 0.08 and a.score >= 0.25
  and exists (select 1 from pv2 join mk using (gene) where pv2."type" = a."type" and mk."cluster" = a."cluster" and pv2.n >= 2)),
 l3 as (select "cluster", l3 from ok qualify row_number() over (partition by "cluster" order by score desc, l3) = 1)
 select "cluster", coalesce(l3, l2) "label", case when l3 is not null then 'L3' else 'L2' end tier, case when l3 is not null then 'resolved' when l2 in (select parent from par where parent <> "type") then 'unresolved' else 'na' end resolution from l2 left join l3 using ("cluster")""")
def tiered_labels(spark, d):
    """Major types, and subtypes that pass all gates."""
    base = checkpoint(kb(spark, d))
    private = base.join(base.groupBy("gene").agg(F.count(F.lit(1)).alias("c")).where("c <= 2"), "gene", "left_semi")
    return annotation.tiered(rounded(spark, d), parents(spark, d).where("type <> parent"), markers(spark, d), private)


@query("""t as (select "cluster", max(score) top, count(*) filter (score >= 0.25) n_high from s group by 1) select "cluster", case when n_mt >= 3 then 'low_quality_data' when n_high >= 2 then 'ambiguous' when coalesce(top, 0) > 0 and top < 0.25 then 'weak_signal'
 when coalesce(top, 0) <= 0 then 'no_kb_match' else 'true_unknown' end category from (select distinct "cluster" from mk) left join t using ("cluster") left join (select "cluster", count(*) filter (gene like 'M%') n_mt from rk where k <= 20 group by 1) using ("cluster")""")
def unknown_diagnosis(spark, d):
    """Why each group would be without a label."""
    m = markers(spark, d)
    first = annotation.ranked(m).where("k <= 20").groupBy("cluster").agg(F.count_if(F.col("gene").startswith("M")).alias("n"))
    return annotation.diagnose_unknown(m, rounded(spark, d), first.where("n >= 3").select("cluster", F.lit("mito_high").alias("reason")))


@query("""k2 as (select type_key, regexp_replace(regexp_replace(strip_accents(lower(type_key)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') k from kb_type), s2 as (select distinct type_key, regexp_replace(regexp_replace(strip_accents(lower(u)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') k from (select type_key, unnest(synonyms) u from kb_type)),
 nm as (select type_key, ascii(type_key) % 7 n from kb_type), gv as (select distinct cell_type_std "label", regexp_replace(regexp_replace(strip_accents(lower(cell_type_std)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') k from obs_annotated where cell_type_std is not null),
 ha as (select "label", list_sort(list(distinct type_key)) al, max(n) mx, list(type_key order by n desc, type_key desc)[1] b, count(*) filter (n = m2) c from (select *, max(n) over (partition by "label") m2 from gv join k2 using (k) join nm using (type_key)) group by 1),
 hb as (select "label", list_sort(list(distinct type_key)) al, max(n) mx, list(type_key order by n desc, type_key desc)[1] b, count(*) filter (n = m2) c from (select *, max(n) over (partition by "label") m2 from gv join s2 using (k) join nm using (type_key)) group by 1)
 select gv."label", case when ha.al is not null and hb.al is not null then case when ha.al = hb.al and ha.c = 1 then ha.b end when ha.al is not null then case when ha.c = 1 then ha.b end when hb.c = 1 then hb.b end type_key from gv left join ha using ("label") left join hb using ("label") where gv.k <> ''""")
def harmonised_labels(spark, d):
    """Canonical types of the labels of an earlier pass."""
    types = table(spark, d, "kb_type")
    return annotation.harmonised(table(spark, d, "obs_annotated").where("cell_type_std is not null"), "cell_type_std", types.select("type_key", "synonyms"), types.select("type_key", (F.ascii("type_key") % 7).cast("bigint").alias("n")))


@query("""mb as (select parent category, "type" from par), sz as (select category, count(distinct "type") nm from mb group by 1), ct as (select category, gene, count(*) n, any_value(nm) nm from mb join kb using ("type") join sz using (category) group by 1, 2),
 q as (select *, row_number() over (partition by category order by n desc, gene desc) as rank, n >= nm / 2 half, least(count(*) filter (n >= nm / 2) over (partition by category), 3) nh from ct),
 kp as (select *, count(*) over (partition by category) m from q where case when nh >= 3 then half and rank <= 3 else n >= nm * 0.3 and rank <= 3 end) select category, gene, rank from kp where m >= 3""")
def category_gene_sets(spark, d):
    """Genes that many types of a parent have."""
    out = annotation.category_markers(parents(spark, d).select(F.col("parent").alias("category"), "type"), kb(spark, d))
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("""t3 as (select "type", gene, row_number() over (partition by "type" order by n desc, gene) as rank from kb) select "type", gene, rank from t3 where rank <= 3""")
def consensus_markers(spark, d):
    return annotation.top_consensus(kb(spark, d)).withColumn("rank", F.col("rank").cast("bigint"))


_SHARE = """ms as (select "type", gene from kb where gene in (select gene from fr)), es as (select "cluster", ms."type", sum(pct) / any_value(c) score from fr join ms using (gene) join (select "type", count(*) c from ms group by 1) z on z."type" = ms."type" group by 1, 2),
 eo as (select "cluster", "type", round(score, 9) score from es)"""


@query(_SHARE + """ select "cluster", "type", round(score, 6) score from es""")
def expression_shares(spark, d):
    """Mean expressed share of each type's markers."""
    return _r(annotation.expressed_share(fractions(spark, d), kb(spark, d)), "score")


@query(_SHARE + """, o as (select *, row_number() over w k, lead(score) over w nx from eo window w as (partition by "cluster" order by score desc, "type")) select "cluster", "type", round(score, 6) score, round(score - nx, 6) gap from o where k = 1 and nx is not null and score >= 0.005 and score - nx > 0.001""")
def decisive_shares(spark, d):
    """Groups whose best type by expressed shares is clearly ahead."""
    shares = annotation.expressed_share(fractions(spark, d), kb(spark, d)).withColumn("score", F.round("score", 9))
    return _r(annotation.decisive(shares, 0.005, 0.001), "score", "gap")


@query("""b as (select "cluster", "type" from s qualify row_number() over (partition by "cluster" order by score desc, "type") = 1 and score >= 0.25), t3 as (select "type", gene from (select "type", gene, row_number() over (partition by "type" order by n desc, gene) r from kb) where r <= 3 and gene in (select gene from fr))
 select b."cluster", b."type" from b join t3 on t3."type" = b."type" left join fr on fr."cluster" = b."cluster" and fr.gene = t3.gene group by 1, 2 having max(coalesce(pct, 0)) < 0.05""")
def unsupported_labels(spark, d):
    """Labels whose best markers hardly any cell expresses."""
    return annotation.unsupported(annotation.best_types(rounded(spark, d)).select("cluster", "type"), fractions(spark, d), kb(spark, d))


_BROAD = """br as (select "cluster", case "type" when 'T8' then 'Broad_Progenitor' when 'T9' then 'Broad_Neuron' when 'T10' then 'Broad_Glia' else 'Broad_Non-neural' end "type", max(score) score from s group by 1, 2),
 bc as (select "cluster", "type" from br where "type" <> 'Broad_Progenitor' qualify row_number() over (partition by "cluster" order by score desc, "type") = 1)"""


def _broad(spark, d) -> DataFrame:
    role = F.when(F.col("type") == "T8", "Broad_Progenitor").when(F.col("type") == "T9", "Broad_Neuron").when(F.col("type") == "T10", "Broad_Glia").otherwise("Broad_Non-neural")
    return rounded(spark, d).groupBy("cluster", role.alias("type")).agg(F.max("score").alias("score"))


@query(_BROAD + """ select "cluster", "type" category from bc""")
def broad_categories(spark, d):
    return annotation.broad_category(_broad(spark, d)).select("cluster", F.col("type").alias("category"))


@query(_BROAD + """, b as (select "cluster", "type" from s qualify row_number() over (partition by "cluster" order by score desc, "type") = 1),
 g as (select b."cluster", b."type", case when right(b."type", 1) = '2' then 'Broad_Glia' when right(b."type", 1) = '3' then bc."type" else bc."type" end category from b left join bc using ("cluster"))
 select "cluster", "type", category, case when contains("type", '7') then 'cycling' when category in ('Broad_Neuron', 'Broad_Glia', 'Broad_Non-neural') and ascii("cluster") % 2 = 0 then 'terminal' else 'N/A' end state from (select "cluster", replace("type", '7', 'Proliferating_7') "type", category from g)""")
def guarded_states(spark, d):
    """Categories set right by the type's own parent, and the state that follows."""
    best = annotation.best_types(rounded(spark, d), float("-inf")).select("cluster", "type").join(broad_categories(spark, d), "cluster", "left")
    own = best.select("type").distinct().select("type", F.when(F.substring("type", -1, 1) == "2", "Broad_Glia").when(F.substring("type", -1, 1) == "3", "Broad_Progenitor").alias("category"))
    g = annotation.guarded_category(best, own).withColumn("type", F.replace("type", F.lit("7"), F.lit("Proliferating_7")))
    level = F.when(F.ascii("cluster") % 2 == 0, "high").otherwise("low")
    return g.select("cluster", "type", "category", annotation.cell_state(F.lit("marker_scoring"), F.col("type"), F.col("category"), level).alias("state"))


@query("""o as (select distinct cell_type_std t from obs_annotated where cell_type_std is not null), r as (select t, coalesce(parent, t) ct from o left join kb_type on type_key = t)
 select t "cluster", ct cell_type, case when t <> ct then t when ct in (select parent from kb_type where parent is not null) then 'unresolved' else 'N/A' end subtype from r""")
def lifted_types(spark, d):
    """Recorded types lifted to their major type."""
    types = table(spark, d, "kb_type")
    given = table(spark, d, "obs_annotated").where("cell_type_std is not null").select(F.col("cell_type_std").alias("type")).distinct().withColumn("cluster", F.col("type"))
    return annotation.lifted(given, knowledge.ancestors(types), types.where("parent is not null").select("parent"))


@query("""o as (select lower(annot_confidence) c from obs_annotated) select count(*) n_cells, round(count(*) filter (c = 'high') / count(*), 6) pass_rate, count(*) filter (c = 'high') / count(*) < 0.1 blind_spot,
 case when count(*) filter (c = 'high') / count(*) < 0.1 then 'relaxed' when count(*) filter (c = 'high') / count(*) < 0.3 then 'deep' else 'default' end strictness from o""")
def annotation_quality(spark, d):
    return _r(annotation.quality_report(table(spark, d, "obs_annotated"), F.lower("annot_confidence") == "high"), "pass_rate")


@query("""c as (select grp tissue, species, count(distinct leiden) n, o.dataset_id from sample_entry e join obs_annotated o using (sample_id) where grp is not null and species is not null group by all),
 a as (select tissue, species, floor(median(n))::bigint own from c group by 1, 2), b as (select tissue, floor(median(n))::bigint anyn from c group by 1), w as (select distinct grp tissue, 'human' species from sample_entry where grp is not null)
 select tissue, species, coalesce(own, anyn) n_clusters from w left join a using (tissue, species) left join b using (tissue)""")
def suggested_cluster_numbers(spark, d):
    """Clusters to expect of each sample group in one species."""
    e = table(spark, d, "sample_entry").where("grp is not null and species is not null").select("sample_id", F.col("grp").alias("tissue"), "species")
    counts = e.join(table(spark, d, "obs_annotated").select("sample_id", "dataset_id", "leiden"), "sample_id").groupBy("tissue", "species", "dataset_id").agg(F.countDistinct("leiden").alias("n"))
    wanted = table(spark, d, "sample_entry").where("grp is not null").select(F.col("grp").alias("tissue"), F.lit("human").alias("species")).distinct()
    return annotation.suggested_clusters(counts, wanted)


@query("""o as (select *, row_number() over (partition by "cluster" order by score desc, "type") k from s), p as (select a."cluster", a."type" t1, b."type" t2 from o a join o b using ("cluster") where a.k = 1 and b.k = 2 and a.score - b.score < 0.15 and a.score >= 0.05 and not (least(a."type", b."type") = 'T10' and greatest(a."type", b."type") = 'T15'))
 select distinct p."cluster", t1 type1, t2 type2 from p join kb a on a."type" = t1 join kb b on b."type" = t2 and b.gene = a.gene where not exists (select 1 from kb c where c."type" = 'T9' and c.gene = a.gene)""")
def transition_pairs(spark, d):
    """Groups between two types of one parent, here one type for all."""
    forbidden, base = spark.sql("select 'T15' a, 'T10' b"), kb(spark, d)
    return annotation.transitions(rounded(spark, d), base.select("type", F.lit("T9").alias("parent")).distinct(), base, forbidden, least=0.05)


@query("""pk as (select p_brand "type", p_type gene, s_suppkey source from lineitem join part on l_partkey = p_partkey join supplier on s_suppkey = l_suppkey where s_suppkey % 2 = 0 and s_nationkey < 3), pn as (select distinct p_brand "type", p_type gene from part where p_size = 50),
 ru as (select p_partkey rule_id, case when p_size % 9 = 0 then 'nothing' else p_brand end action, p_type gene, p_size % 2 = 0 present from part), cc as (select "type", count(distinct gene) g, count(distinct source) sn from pk group by 1)
 select 'few markers' rule, "type" item from cc where g < 5 union select 'few sources', "type" from cc where sn < 3 union select 'positive and negative', "type" || '|' || gene from pk semi join pn using ("type", gene)
 union select 'unknown action', rule_id::varchar from ru where action not in (select "type" from pk) union select 'contradiction', rule_id::varchar from ru a where present and exists (select 1 from ru b where b.rule_id = a.rule_id and b.gene = a.gene and not b.present)""")
def kb_findings(spark, d):
    """Violations of a knowledge base's rules, of brands in the role of types."""
    part = table(spark, d, "part")
    some = table(spark, d, "supplier").where("s_suppkey % 2 = 0 and s_nationkey < 3").select(F.col("s_suppkey").alias("l_suppkey"))
    base = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").join(some, "l_suppkey").join(part.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
    base = base.select(F.col("p_brand").alias("type"), F.col("p_type").alias("gene"), F.col("l_suppkey").alias("source")).distinct()
    bad = part.where("p_size = 50").select(F.col("p_brand").alias("type"), F.col("p_type").alias("gene")).distinct()
    rules = part.select(F.col("p_partkey").alias("rule_id"), F.when(F.col("p_size") % 9 == 0, "nothing").otherwise(F.col("p_brand")).alias("action"), F.col("p_type").alias("gene"), (F.col("p_size") % 2 == 0).alias("present"))
    return annotation.kb_violations(base, bad, rules, 5, 3)


@query("""dc as (select row_id "cluster", case when leiden = '1' then 'ambiguous' when leiden = '2' then 'transition_state' else 'marker_scoring' end "method", lower(annot_confidence) confidence from obs_annotated where leiden is not null)
 select "method", confidence, count(*) n from dc where confidence in ('low', 'unknown') and "method" <> 'ambiguous' or "method" in ('ambiguous', 'transition_state') group by 1, 2""")
def second_pass_cells(spark, d):
    """What a second pass would look at, by method and confidence."""
    method = F.when(F.col("leiden") == "1", "ambiguous").when(F.col("leiden") == "2", "transition_state").otherwise("marker_scoring")
    dec = table(spark, d, "obs_annotated").where("leiden is not null").select(F.col("row_id").alias("cluster"), method.alias("method"), F.lower("annot_confidence").alias("confidence"))
    return annotation.second_pass(dec, potency=True).groupBy("method", "confidence").agg(F.count(F.lit(1)).alias("n"))


@query("""lc as (select dataset_id || '|' || group_label "cluster", names gene from marker_gene where dataset_id is not null and group_label is not null and names is not null), up as (select distinct gene from kb),
 a as (select "cluster", count(distinct gene) h from lc where gene in (select gene from up where left(gene, 1) < 'H') group by 1), b as (select "cluster", count(distinct upper(gene)) h from lc where upper(gene) in (select gene from up where left(gene, 1) < 'H') group by 1)
 select "cluster", case when coalesce(a.h, 0) = 0 and coalesce(b.h, 0) > 0 then b.h else coalesce(a.h, 0) end hits, coalesce(a.h, 0) = 0 and coalesce(b.h, 0) > 0 retried from (select distinct "cluster" from lc) left join a using ("cluster") left join b using ("cluster")""")
def retried_scores(spark, d):
    """Hits of a second look without regard to letter case where the first found none."""
    lc = table(spark, d, "marker_gene").where("dataset_id is not null and group_label is not null and names is not null").select(F.concat_ws("|", "dataset_id", "group_label").alias("cluster"), F.col("names").alias("gene"))
    known = kb(spark, d).where(F.substring("gene", 1, 1) < "H").select("gene").distinct()
    count = lambda df: df.distinct().join(known, "gene").groupBy("cluster").agg(F.count(F.lit(1)).alias("hits"))
    return annotation.retried(count(lc), count(lc.withColumn("gene", F.upper("gene"))), lc)


@query("""g as (select distinct cell_type_raw nm, lower(regexp_replace(cell_type_raw, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')) lo from obs_annotated where cell_type_raw is not null and regexp_replace(cell_type_raw, '[\\s\\p{Z}]+', '', 'g') <> ''),
 en as (select type_key, lower(display_name) tx, 0 kd from kb_type union select type_key, lower(s), 1 from (select type_key, unnest(synonyms) s from kb_type) union select type_key, lower(type_key), 2 from kb_type),
 a as (select nm, 1 tier, 0 kd, 0.0::double ms, type_key from g join kb_type on type_key = nm union all select nm, kd + 2, kd, 0.0, type_key from g join en on tx = lo and kd < 2), r as (select * from g where nm not in (select nm from a) and length(lo) >= 3),
 b as (select nm, 4, kd, 0.0::double, type_key from r join en on kd < 2 and length(tx) >= 3 and (contains(lo, tx) or contains(tx, lo)) union all
  select nm, 5, 0, round(levenshtein(regexp_replace(lo, '[^\\x01-\\x7f]', '#', 'g'), tx)::double / greatest(length(lo), length(tx)), 9), type_key from r join en on length(tx) >= 3 and abs(length(lo) - length(tx)) < 0.15 * greatest(length(lo), length(tx)) and 1 - levenshtein(regexp_replace(lo, '[^\\x01-\\x7f]', '#', 'g'), tx)::double / greatest(length(lo), length(tx)) > 0.85::double),
 u as (select * from a union all select * from b), t as (select nm, tier, type_key from u qualify row_number() over (partition by nm order by tier, kd, ms, type_key) = 1)
 select nm as "name", coalesce(type_key, nm) type_key, coalesce(tier, 6) tier, case when coalesce(tier, 6) <= 3 then 'high' when tier <= 5 then 'medium' else 'low' end confidence from g left join t using (nm)""")
def standardised_names(spark, d):
    """Typed names by the six tiers."""
    names = table(spark, d, "obs_annotated").where("cell_type_raw is not null")
    return annotation.standardised(names, "cell_type_raw", table(spark, d, "kb_type"))
