"""Queries on intervals, networks, space, comparisons, bulk samples, text and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.functions import text
from spindrel.operators import bulk, comparison, intervals, network, spatial
from spindrel.plans import roles
from spindrel.plans.book import Book
from spindrel.runtime import checkpoint, strip, table
from spindrel.streaming import quality_stream

BOOK = Book("with ")
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- intervals


def _events(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.col("user_id").cast("string").alias("chrom"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("pos"), "event_type", "value")


@query("""e as (select event_id, user_id::varchar chrom, epoch(date_trunc('second', ts))::bigint pos, event_type t from events),
 f as (select chrom, pos site, min(event_id::varchar) nm from e where t = 'purchase' group by all), p as (select event_id::varchar id, chrom, pos from e where t = 'click'),
 a as (select p.*, (select min(site) from f where f.chrom = p.chrom and site >= pos) s1, (select max(site) from f where f.chrom = p.chrom and site < pos) s2 from p),
 b as (select *, case when s1 is not null and (s2 is null or s1 - pos <= pos - s2) then s1 else s2 end s from a)
 select id, b.chrom, pos, case when abs(s - pos) <= 43200 then nm end as name, case when abs(s - pos) <= 43200 then abs(s - pos) end distance from b left join f on f.chrom = b.chrom and f.site = b.s""")
def nearest_feature(spark, d):
    e = _events(spark, d)
    features = e.where("event_type = 'purchase'").select("chrom", F.col("pos").alias("site"), F.col("event_id").cast("string").alias("name"))
    points = e.where("event_type = 'click'").select(F.col("event_id").alias("id"), "chrom", "pos")
    return intervals.nearest(points, features, 43_200)


@query("""e as (select event_id id, (user_id % 10)::varchar chrom, epoch(date_trunc('second', ts))::bigint s, epoch(date_trunc('second', ts))::bigint + 60 + floor("value" * 20)::bigint e, event_type t from events)
 select a.id id_a, count(*) n, sum(least(a.e, b.e) - greatest(a.s, b.s))::bigint bases from e a join e b on a.chrom = b.chrom and a.s < b.e and b.s < a.e where a.t = 'click' and b.t = 'view' group by 1""")
def interval_overlaps(spark, d):
    """Overlapping partners and bases of each interval."""
    e = _events(spark, d).withColumn("chrom", F.pmod(F.col("chrom").cast("bigint"), F.lit(10)).cast("string"))
    e = e.select(F.col("event_id").alias("id"), "chrom", F.col("pos").alias("start"), (F.col("pos") + 60 + F.floor(F.col("value") * 20)).alias("end"), "event_type")
    o = intervals.overlaps(e.where("event_type = 'click'"), e.where("event_type = 'view'"), 3600)
    bases = F.least("end_a", "end_b") - F.greatest("start_a", "start_b")
    return o.groupBy("id_a").agg(F.count(F.lit(1)).alias("n"), F.sum(bases).alias("bases"))


@query("""e as (select user_id::varchar chrom, epoch(date_trunc('second', ts))::bigint pos from events) select chrom, max(pos) + 10000 size from e group by 1""")
def chromosome_sizes(spark, d):
    return intervals.chrom_sizes(_events(spark, d).withColumn("end", F.col("pos")))


# --- networks

_PATHWAYS = """pw as (select p_brand || ' ' || p_type term, p_type kind, min(p_retailprice) / 100000 p_adj, list_sort(list(distinct p_name)) genes from part group by all),
 rel as (select term, kind, p_adj, len(list_filter(genes, lambda g: g in ('red widget', 'small ring', 'blue bolt'))) ov, len(genes) n from pw),
 re2 as (select *, ov / n ratio, -log10(greatest(p_adj, 1e-300)) * (1 + ov / n) relevance from rel)
"""


def _pathways(spark, d):
    p = table(spark, d, "part")
    return p.groupBy(F.concat("p_brand", F.lit(" "), "p_type").alias("term"), F.col("p_type").alias("kind")).agg(
        (F.min("p_retailprice") / 100000).alias("p_adj"), F.sort_array(F.collect_set("p_name")).alias("genes")
    )


MARKERS = ["red widget", "small ring", "blue bolt"]


@query(_PATHWAYS + " select term, ov overlap, round(ratio, 6) ratio, round(relevance, 6) relevance from re2")
def pathway_relevance(spark, d):
    return _r(network.pathway_relevance(_pathways(spark, d), MARKERS), "ratio", "relevance").select("term", "overlap", "ratio", "relevance")


@query(_PATHWAYS + """, f as (select term, contains(lower(term), 'brand#2') al, contains(lower(term), 'economy') de, (relevance - min(relevance) over ()) / (max(relevance) over () - min(relevance) over ()) s from re2),
 m as (select median(s) v from f where not al and not de), g as (select term, case when al then 1.0::double when de then -1.0::double when s > v then s else 0.0::double end ts from f, m)
 select term, round(ts, 6) tissue_score, ts > 0 kept from g""")
def tissue_pathways(spark, d):
    rel = network.pathway_relevance(_pathways(spark, d), MARKERS)
    return _r(network.tissue_filter(rel, ["brand#2"], ["economy"]), "tissue_score").select("term", "tissue_score", "kept")


@query()
def redundant_pathways(spark, d):
    """Leader of each pathway among those of its kind."""
    return network.redundant_terms(_pathways(spark, d), "kind")


_NET = """net as (select l_suppkey source, p_brand target, sum(l_discount - 0.05) weight from lineitem join part on l_partkey = p_partkey group by all)
"""


def _net(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("target"))
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_discount").join(part, "l_partkey")
    return lines.groupBy(F.col("l_suppkey").alias("source"), "target").agg(F.sum(F.col("l_discount") - 0.05).alias("weight"))


@query(_NET + ", k as (select source from net group by 1 having count(distinct target) >= 20) select source, target, round(weight, 6) + 0.0 weight from net semi join k using (source)")
def wide_regulons(spark, d):
    return _r(network.regulons(_net(spark, d), 20), "weight").select("source", "target", "weight")


_ACT = _NET + """, x as (select l_orderkey cell_id, p_brand gene, sum(l_quantity) v from lineitem join part on l_partkey = p_partkey group by all),
 ex as (select o_orderpriority grp, gene, avg(v) mean from x join orders on o_orderkey = cell_id group by all),
 gr as (select e.grp, e.gene, e.mean, s.source, coalesce(n.weight, 0) w from ex e cross join (select distinct source from net) s left join net n on n.source = s.source and n.target = e.gene),
 ac as (select grp, source, corr(w, mean) r, count(*) n from gr group by all), tt as (select grp, source, r * sqrt((n - 2) / (1 - r * r)) t from ac)
"""


def _activity(spark, d):
    x = roles.counts(spark, d).join(roles.cells(spark, d).select("cell_id", F.col("cluster").alias("grp")), "cell_id")
    return network.activity(x.groupBy("grp", F.col("gene_id").alias("gene")).agg(F.avg("value").alias("mean")), _net(spark, d))


@query(_ACT + " select grp, source, round(t, 5) + 0.0 t from tt")
def regulator_activity(spark, d):
    return _r(_activity(spark, d), "t", digits=5).select("grp", "source", "t")


@query(_ACT + """, s as (select source, avg((upper(target) in ('BRAND#1', 'BRAND#2', 'BRAND#3'))::int) ratio from net group by 1), m as (select source, avg(abs(t)) activity, var_samp(t) variance from tt group by 1)
 select source, round(ratio, 6) ratio, round(activity, 5) activity, round(variance, 5) variance, round(activity * (1 + ratio), 5) relevance from m join s using (source)""")
def regulator_relevance(spark, d):
    out = network.source_relevance(_activity(spark, d), _net(spark, d), ["Brand#1", "brand#2", "Brand#3"])
    return _r(_r(out, "ratio"), "activity", "variance", "relevance", digits=5)


@query("""ad as (select n_name source, 'NATION_' || (n_nationkey * 7 + 1) % 25 target, r_name kind from nation join region on n_regionkey = r_regionkey),
 pr as (select n_name source, 'nation_' || (n_nationkey * k + 1) % 25 target from nation cross join (values (7), (3), (18)) v(k)),
 ks as (select lower(source) s, lower(target) t, min(kind) kind from ad group by 1, 2)
 select p.source, p.target, coalesce(f.kind, b.kind) kind from pr p left join ks f on f.s = lower(p.source) and f.t = lower(p.target) left join ks b on b.t = lower(p.source) and b.s = lower(p.target)""")
def contact_kinds(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    other = lambda k, word: F.concat(F.lit(word), ((F.col("n_nationkey") * k + 1) % 25).cast("string"))
    adjacency = nation.select(F.col("n_name").alias("source"), other(7, "NATION_").alias("target"), F.col("r_name").alias("kind"))
    pairs = nation.select(F.col("n_name").alias("source"), F.explode(F.array(*[other(k, "nation_") for k in (7, 3, 18)])).alias("target"))
    return network.adjacency_matches(pairs, adjacency)


@query("""x as (select l_orderkey cell_id, p_brand gene, sum(l_quantity) v from lineitem join part on l_partkey = p_partkey group by all), s as (select o_orderpriority grp, gene, sum(v) / any_value(n) mean, count(*) / any_value(n) prop
  from x join orders on o_orderkey = cell_id join (select o_orderpriority g, count(*) n from orders group by 1) z on z.g = o_orderpriority group by 1, 2),
 pr(ligand, receptor) as (values ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#4'), ('Brand#3', 'Brand#99'))
 select ligand, receptor, a.grp source, b.grp target, round((a.mean + b.mean) / 2, 6) lr_mean, round(a.mean * b.mean, 6) lr_prod from pr join s a on a.gene = ligand join s b on b.gene = receptor""")
def ligand_receptor(spark, d):
    obs = roles.cells(spark, d).select("cell_id", F.col("cluster").alias("grp"))
    n = obs.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    s = roles.counts(spark, d).join(obs, "cell_id").groupBy("grp", F.col("gene_id").alias("gene")).agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("c"))
    s = s.join(n, "grp").select("grp", "gene", (F.col("s") / F.col("n")).alias("mean"), (F.col("c") / F.col("n")).alias("prop"))
    pairs = spark.sql("select * from values ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#4'), ('Brand#3', 'Brand#99') as t(ligand, receptor)")
    out = network.interactions(s, pairs)
    return _r(out, "lr_mean", "lr_prod").select("ligand", "receptor", "source", "target", "lr_mean", "lr_prod")


@query("""m as (select dataset_id, names gene, max(scores) metric from marker_gene where dataset_id is not null and names is not null and scores is not null and not isnan(scores) group by all),
 h as (select *, substring(gene, 1, 1) in ('B', 'b', 'C', 'c') hit from m),
 r as (select *, sum(case when hit then abs(metric) else 0 end) over w / nullif(sum(case when hit then abs(metric) else 0 end) over (partition by dataset_id), 0) a,
  sum((not hit)::int) over w / nullif(sum((not hit)::int) over (partition by dataset_id), 0) b from h window w as (partition by dataset_id order by metric desc, gene rows between unbounded preceding and current row)),
 e as (select dataset_id, max(coalesce(a, 0) - coalesce(b, 0)) x, min(coalesce(a, 0) - coalesce(b, 0)) n, sum(hit::int)::bigint n_hits from r group by 1)
 select dataset_id, round(case when x >= -n then x else n end, 5) + 0.0 es, n_hits from e""")
def enrichment_score(spark, d):
    """Running-sum score of a gene set in the ranking of each data set."""
    real = "dataset_id is not null and names is not null and scores is not null and not isnan(scores)"
    m = table(spark, d, "marker_gene").where(real).groupBy("dataset_id", F.col("names").alias("gene")).agg(F.max("scores").alias("metric"))
    return _r(network.enrichment_score(m, ["dataset_id"], F.substring("gene", 1, 1).isin("B", "b", "C", "c")), "es", digits=5)


# --- space

_SPOTS = """sp as (select vec_id id, embedding[1]::double px, embedding[2]::double py, label from embeddings),
 eg as (select a.id src, b.id dst, sqrt(pow(a.px - b.px, 2) + pow(a.py - b.py, 2)) distance from sp a join sp b on a.id <> b.id where sqrt(pow(a.px - b.px, 2) + pow(a.py - b.py, 2)) <= 0.05)
"""


def _spots(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("px"), F.col("embedding")[1].cast("double").alias("py"), "label")


@query(_SPOTS + " select src, count(*) n, round(sum(distance), 6) total from eg group by 1")
def radius_graph(spark, d):
    g = spatial.radius_graph(_spots(spark, d), 0.05)
    return _r(g.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("total")), "total")


@query("""sp as (select vec_id id, embedding[1]::double px, embedding[2]::double py from embeddings), eg as (select a.id src, b.id dst, sqrt(pow(a.px - b.px, 2) + pow(a.py - b.py, 2)) distance from sp a join sp b on a.id <> b.id)
 select src, dst, row_number() over (partition by src order by distance, dst) as rank from eg qualify rank <= 6""")
def nearest_graph(spark, d):
    return spatial.nearest_graph(_spots(spark, d), 6).select("src", "dst", F.col("rank").cast("bigint").alias("rank"))


@query(_SPOTS + """, v as (select id, 'px' feature, px v from sp union all select id, 'label', label::double from sp), z as (select id, feature, v - avg(v) over (partition by feature) z from v),
 c as (select a.feature, sum(a.z * b.z) num, count(*) w from eg join z a on a.id = src join z b on b.id = dst and b.feature = a.feature group by 1), o as (select feature, count(*) n, sum(z * z) den from z group by 1)
 select feature, round(n / w * num / den, 6) + 0.0 moran from c join o using (feature)""")
def spatial_autocorrelation(spark, d):
    s = _spots(spark, d)
    values = s.select("id", F.lit("px").alias("feature"), F.col("px").alias("v")).unionByName(s.select("id", F.lit("label").alias("feature"), F.col("label").cast("double").alias("v")))
    return _r(spatial.morans_i(values, spatial.radius_graph(s, 0.05).withColumn("w", F.lit(1.0))), "moran")


@query(_SPOTS + """, n as (select a.label a, b.label b, count(*) n from eg join sp a on a.id = src join sp b on b.id = dst group by all)
 select a, b, n, round(n / (sum(n) over (partition by a) * sum(n) over (partition by b) / sum(n) over ()), 6) ratio from n""")
def label_contacts(spark, d):
    s = _spots(spark, d)
    return _r(spatial.label_contacts(spatial.radius_graph(s, 0.05), s), "ratio")


@query(_SPOTS + """ select a.label a, b.label b, least(floor(distance / (0.05 / 5)), 4)::int bin, count(*) n from eg join sp a on a.id = src join sp b on b.id = dst group by all""")
def co_occurrence(spark, d):
    s = _spots(spark, d)
    return spatial.co_occurrence(s, s, 0.05, 5)


# --- comparisons

_SETS = """gs as (select dataset_id || '|' || group_label "cluster", upper(trim(names)) gene, max(scores) s from marker_gene where dataset_id is not null and group_label is not null and names is not null and scores is not null and not isnan(scores) group by all),
 tk as (select "cluster", gene from gs qualify row_number() over (partition by "cluster" order by s desc, gene) <= 15), st as (select "cluster", gene from tk qualify count(*) over (partition by "cluster") >= 3),
 df as (select gene, count(*) df from st group by 1), nn as (select count(distinct "cluster") n from st), wt as (select "cluster", gene, ln((n + 1) / (df + 1)) w from st join df using (gene), nn),
 vc as (select "cluster", gene, coalesce(w / nullif(sqrt(sum(w * w) over (partition by "cluster")), 0), 0) w from wt),
 cs as (select a."cluster" a, b."cluster" b, sum(a.w * b.w) cosine from vc a join vc b on a.gene = b.gene and a."cluster" < b."cluster" group by all having sum(a.w * b.w) >= 0.15)
"""
#: Least cosine of an edge.
ALIKE = 0.15


def _vectors(spark, d):
    """The 15 best genes of every cluster with at least 3, weighted."""
    real = "dataset_id is not null and group_label is not null and names is not null and scores is not null and not isnan(scores)"
    rows = table(spark, d, "marker_gene").where(real)
    rows = rows.select(F.concat_ws("|", "dataset_id", "group_label").alias("cluster"), F.upper(strip("names")).alias("gene"), F.col("scores").alias("score"))
    return comparison.idf_vectors(checkpoint(comparison.top_sets(rows)))


@query(_SETS + ' select "cluster", gene, round(w, 6) + 0.0 w from vc')
def gene_set_vectors(spark, d):
    return _r(_vectors(spark, d), "w")


@query(_SETS + " select a, b, round(cosine, 6) cosine from cs")
def similar_clusters(spark, d):
    return _r(comparison.cosine_edges(_vectors(spark, d), ALIKE), "cosine")


@query("recursive " + _SETS + """, ed as (select a u, b v from cs union select b, a from cs), wk as (select distinct "cluster" node, "cluster" root from vc union select ed.v, wk.root from wk join ed on ed.u = wk.node)
 select node, min(root) component from wk group by 1""")
def cluster_communities(spark, d):
    """Connected parts of the similarity graph."""
    v = checkpoint(_vectors(spark, d))
    return comparison.components(v.select(F.col("cluster").alias("node")), comparison.cosine_edges(v, ALIKE))


@query("""n as (select leiden, batch, count(*) n from obs_annotated where batch is not null and leiden is not null group by all), r as (select *, row_number() over (partition by leiden order by n desc, batch) k, sum(n) over (partition by leiden) t from n)
 select leiden, max(batch) filter (k = 1) top, round(max(n / t) filter (k = 1), 6) top_share, max(batch) filter (k = 2) "second", round(max(n / t) filter (k = 2), 6) second_share from r group by 1""")
def label_agreement(spark, d):
    return _r(comparison.label_agreement(table(spark, d, "obs_annotated").where("leiden is not null"), "leiden", "batch"), "top_share", "second_share")


@query("o as (select * from obs_annotated where leiden is not null and batch is not null) select leiden, batch, count(*) n from o group by cube (leiden, batch)")
def confusion_with_margins(spark, d):
    return comparison.confusion(table(spark, d, "obs_annotated"), "leiden", "batch")


@query("""n as (select year(o_orderdate)::int stage, o_orderpriority label, count(*) n from orders group by all) select stage, label, n, round(n / sum(n) over (partition by stage), 6) share from n""")
def composition(spark, d):
    return _r(comparison.composition(table(spark, d, "orders").select(F.year("o_orderdate").alias("stage"), F.col("o_orderpriority").alias("label")), "stage", "label"), "share")


@query("""f as (select 'supplement of unknown paper' finding, paper_id item from supplement_file anti join paper_entry using (paper_id) where paper_id is not null
 union select 'source of unknown paper', paper_id from kb_source anti join paper_entry using (paper_id) where paper_id is not null
 union select 'document of unknown paper', paper_id from documents anti join paper_entry using (paper_id) where paper_id is not null
 union select 'sample without cells', sample_id from sample_entry anti join obs_annotated using (sample_id) where sample_id is not null
 union select 'cells of unknown sample', sample_id from obs_annotated anti join sample_entry using (sample_id) where sample_id is not null
 union select 'share of unknown setting', setting_id::varchar from target_share anti join downsample_setting using (setting_id) where setting_id is not null
 union select 'configuration without markers', dataset_id from de_config anti join marker_gene using (dataset_id) where dataset_id is not null) select * from f""")
def registry_findings(spark, d):
    t = lambda n: table(spark, d, n)
    checks = [
        ("supplement_file", "paper_id", "paper_entry", "supplement of unknown paper"), ("kb_source", "paper_id", "paper_entry", "source of unknown paper"),
        ("documents", "paper_id", "paper_entry", "document of unknown paper"), ("sample_entry", "sample_id", "obs_annotated", "sample without cells"),
        ("obs_annotated", "sample_id", "sample_entry", "cells of unknown sample"),
        ("target_share", "setting_id", "downsample_setting", "share of unknown setting"), ("de_config", "dataset_id", "marker_gene", "configuration without markers"),
    ]
    out = None
    for links, key, targets, finding in checks:
        part = comparison.missing_links(t(links), key, t(targets), key, finding)
        out = part if out is None else out.unionByName(part)
    return out


@query("p as (select distinct paper_id, title from paper_entry) select paper_id, title from p where contains(lower(title), 'granule') or contains(lower(paper_id), 'granule')")
def paper_search(spark, d):
    return comparison.search(table(spark, d, "paper_entry").select("paper_id", "title").distinct(), ["title", "paper_id"], "Granule")


# --- bulk samples

_BULK = """bk as (select c_mktsegment || o_orderstatus sample, p_brand gene, sum(l_quantity) v from lineitem join part on l_partkey = p_partkey join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey group by all)
"""


def _bulk(spark, d):
    status = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), "o_orderstatus", "o_custkey")
    segment = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    x = roles.counts(spark, d).join(status, "cell_id").join(segment, "o_custkey")
    return x.groupBy(F.concat("c_mktsegment", "o_orderstatus").alias("sample"), F.col("gene_id").alias("gene")).agg(F.sum("value").alias("value"))


@query(_BULK + """, g as (select gene, avg(ln(v)) g from bk where v > 0 group by 1 having count(*) = (select count(distinct sample) from bk)) select sample, round(exp(median(ln(v) - g)), 6) size_factor from bk join g using (gene) where v > 0 group by 1""")
def bulk_size_factors(spark, d):
    return _r(bulk.size_factors(_bulk(spark, d)), "size_factor")


@query(_BULK + """ select sample, sum(v)::double total, count(*) n_genes, sum(v) < 1e5 or count(*) < 20 low_quality from bk group by 1""")
def bulk_sample_flags(spark, d):
    return bulk.sample_flags(_bulk(spark, d), 1e5, 20)


@query(_BULK + """, l as (select sample, gene, ln(1 + v) v from bk), s as (select sample, sum(v) s, sum(v * v) q from l group by 1),
 dt as (select a.sample a, b.sample b, sum(a.v * b.v) d from l a join l b on a.gene = b.gene and a.sample < b.sample group by all)
 select a, b, round((d - x.s * y.s / 25) / sqrt((x.q - x.s * x.s / 25) * (y.q - y.s * y.s / 25)), 5) r, round(sqrt(x.q + y.q - 2 * d), 5) distance from dt join s x on x.sample = a join s y on y.sample = b""")
def bulk_sample_correlation(spark, d):
    return _r(bulk.sample_correlation(_bulk(spark, d), 25), "r", "distance", digits=5)


@query(_BULK + """, j as (select *, right(sample, 1) batch from bk), w as (select *, avg(v) over (partition by gene) ga, stddev_pop(v) over (partition by gene) gs, avg(v) over (partition by gene, batch) ba, stddev_pop(v) over (partition by gene, batch) bs from j)
 select sample, gene, round(case when bs > 0 then (v - ba) / bs else 0 end * gs + ga, 4) aligned from w""")
def bulk_batch_alignment(spark, d):
    x = _bulk(spark, d)
    batches = x.select("sample").distinct().withColumn("batch", F.substring("sample", -1, 1))
    return _r(bulk.batch_aligned(x, batches), "aligned", digits=4).select("sample", "gene", "aligned")


@query()
def bulk_two_conditions(spark, d):
    """Negative-binomial test of finished against open orders."""
    x = _bulk(spark, d)
    samples = x.select("sample").distinct().withColumn("condition", F.substring("sample", -1, 1))
    return bulk.two_condition_test(x, samples, "F", "O")


# --- text

@query("""z as (select 1) select kb_ref_id, regexp_replace(regexp_replace(lower(kb_id), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') "key" from kb_source where kb_id is not null""")
def label_keys(spark, d):
    return table(spark, d, "kb_source").where("kb_id is not null").select("kb_ref_id", text.label_key(F.col("kb_id")).alias("key"))


@query("""z as (select 1) select type_key, round(case when greatest(length(type_key), length(parent)) = 0 then 1 else 1 - levenshtein(type_key, parent) / greatest(length(type_key), length(parent)) end, 6) similarity from kb_type where parent is not null""")
def name_similarity(spark, d):
    t = table(spark, d, "kb_type").where("parent is not null")
    return _r(t.select("type_key", text.similarity(F.col("type_key"), F.col("parent")).alias("similarity")), "similarity")


@query("""z as (select 1) select event_type, count(*) n, sum((props->>'$.k')::bigint)::bigint total from events group by 1""")
def json_properties(spark, d):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"))


@query(r"""p as (select artifact_id, lower(path) p from artifact where path is not null)
 select case when regexp_matches(p, '\.(tar|zip|tgz|7z|rar)(\.gz)?$') then 'archive' when regexp_matches(p, 'fragments?\.(tsv|bed)(\.gz)?$') then 'fragments' when regexp_matches(p, '\.mtx(\.gz)?$') then 'mtx' when regexp_matches(p, '\.h5ad$') then 'h5ad'
 when regexp_matches(p, '\.h5$') then 'h5' when regexp_matches(p, '\.(csv|tsv|txt)(\.gz)?$') then 'table' else 'unsupported' end format, count(*) n from p group by 1""")
def file_formats(spark, d):
    return table(spark, d, "artifact").where("path is not null").groupBy(text.file_format(F.col("path")).alias("format")).agg(F.count(F.lit(1)).alias("n"))


# --- streams

_WINDOWS = """z as (select 1) select time_bucket(interval '1 hour', ts) window_start, event_type, count(*) n, round(sum("value"), 4) total, min("value") least, max("value") most from events group by 1, 2"""


@query(_WINDOWS)
def windowed_metrics(spark, d):
    return _r(quality_stream.windowed(table(spark, d, "events"), "1 hour"), "total", digits=4)


@query(_WINDOWS)
def streamed_metrics(spark, d):
    """The same by a stream that reads the table's files to their end."""
    schema = table(spark, d, "events").schema
    out = quality_stream.run_to_table(spark, f"{d}/events.parquet", schema, "1 hour")
    return _r(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "total", digits=4)


@query("""g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval '30 minutes' then 0 else 1 end f from events), s as (select *, sum(f) over (partition by user_id order by ts rows unbounded preceding) k from g)
 select user_id, min(ts) "start", max(ts) + interval '30 minutes' "end", count(*) n from s group by user_id, k""")
def user_sessions(spark, d):
    return quality_stream.sessions(table(spark, d, "events"))
