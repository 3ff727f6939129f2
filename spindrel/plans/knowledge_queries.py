"""Queries of the knowledge base, annotation and the choice among clusterings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.operators import clusters, knowledge
from spindrel.plans import roles
from spindrel.plans.book import Book
from spindrel.runtime import table

SQL = """with kb as (select distinct s_nationkey "type", case when l_quantity >= 48 then 'confirm' else 'add' end tier, p_brand gene, s_suppkey source
  from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey),
mg as (select "type", tier, gene, list_sort(list(distinct source)) sources, count(distinct source) n_sources from kb group by all),
"""
BOOK = Book(SQL)
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def kb(spark, d) -> DataFrame:
    """Suppliers as sources, their nations as types, brands as marker genes."""
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("type"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("gene"))
    tier = F.when(F.col("l_quantity") >= 48, "confirm").otherwise("add")
    return lines.join(supplier, "l_suppkey").join(part, "l_partkey").select("type", tier.alias("tier"), "gene", F.col("l_suppkey").alias("source")).distinct()


@query('z as (select 1) select "type", tier, gene, array_to_string(sources, \',\') sources, n_sources from mg')
def kb_merge(spark, d):
    return knowledge.merge_markers(kb(spark, d)).withColumn("sources", F.array_join(F.col("sources").cast("array<string>"), ","))


@query("""z as (select 1) select "type", tier, gene, n_sources, case when n_sources >= 5 then 'gold' when n_sources >= 3 then 'high' when n_sources >= 2 then 'medium' else 'low' end level from mg""")
def kb_consensus(spark, d):
    return knowledge.merge_markers(kb(spark, d)).select("type", "tier", "gene", "n_sources", knowledge.consensus(F.col("n_sources")).alias("level"))


@query("""b as (select distinct "type", gene, source from kb), rt as (select s_suppkey source, s_suppkey % 7 root from supplier where s_suppkey % 3 <> 0),
 inj as (select distinct "type", source from b where source % 11 = 0), md as (select s_suppkey source, case when s_suppkey % 2 = 0 then 'rna' else 'atac' end modality from supplier),
 v as (select "type", gene, source, case when exists (select 1 from inj where inj."type" = b."type" and inj.source = b.source) then 0.0
  when not exists (select 1 from rt where rt.source = b.source) then 1.0
  when exists (select 1 from b o join rt using (source) where o."type" = b."type" and o.gene = b.gene and o.source <> b.source and rt.root = b.source % 7) then 0.5 else 1.0 end vote from b),
 sh as (select b."type", b.gene, root from b join rt using (source) join md using (source) where not exists (select 1 from inj where inj."type" = b."type" and inj.source = b.source)
  group by 1, 2, 3 having count(distinct b.source) >= 2 and count(distinct modality) >= 2)
 select "type", gene, sum(vote)::double + case when exists (select 1 from sh where sh."type" = v."type" and sh.gene = v.gene) then 0.5::double else 0 end votes from v group by 1, 2""")
def kb_effective_votes(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source"))
    markers = kb(spark, d)
    roots = s.where("source % 3 <> 0").select("source", (F.col("source") % 7).alias("root"))
    injected = markers.where("source % 11 = 0").select("type", "source").distinct()
    modalities = s.select("source", F.when(F.col("source") % 2 == 0, "rna").otherwise("atac").alias("modality"))
    return knowledge.effective_votes(markers, roots, injected, modalities)


@query("""p as (select "type", gene, max(n_sources) n from mg group by all) select a.gene, a."type" type_a, a.n n_a, b."type" type_b, b.n n_b,
 case when a.n >= 3 and a.n > b.n then a."type" when b.n >= 3 and b.n > a.n then b."type" end winner from p a join p b on a.gene = b.gene and a."type" < b."type" """)
def kb_conflicts(spark, d):
    return knowledge.conflicts(knowledge.merge_markers(kb(spark, d)))


@query("""z as (select 1) select gene, count(distinct "type") n_types, min("type") first_type from mg where tier = 'confirm' group by 1 having count(distinct "type") <= 22""")
def kb_private_markers(spark, d):
    return knowledge.private_markers(knowledge.merge_markers(kb(spark, d)).where("tier = 'confirm'"), 22)


@query("z as (select 1) select distinct gene from mg where n_sources >= 2 and gene not in ('Brand#3', 'Brand#5')")
def kb_forced_genes(spark, d):
    return knowledge.forced_genes(knowledge.merge_markers(kb(spark, d)), 2, ["Brand#3", "Brand#5"])


@query("""u as (select p_partkey rule_id, p_size priority, p_brand, p_type from part)
 select rule_id, priority, p_brand, p_type from u qualify row_number() over (partition by p_brand, p_type order by priority, rule_id) = 1""")
def kb_merge_rules(spark, d):
    rules = table(spark, d, "part").select(F.col("p_partkey").alias("rule_id"), F.col("p_size").alias("priority"), "p_brand", "p_type")
    return knowledge.best_rules(rules, ["p_brand", "p_type"])


_MARKERS = """mk as (select "cluster", gene_id gene, avg("value") logfc from (select l_orderkey cell_id, p_brand gene_id, sum(l_quantity) "value" from lineitem join part on l_partkey = p_partkey group by all)
  join (select o_orderkey cell_id, o_orderpriority "cluster" from orders) using (cell_id) group by 1, 2), """


def _markers(spark, d):
    return roles.counts(spark, d).join(roles.cells(spark, d).select("cell_id", "cluster"), "cell_id").groupBy(
        "cluster", F.col("gene_id").alias("gene")
    ).agg(F.avg("value").alias("logfc"))


@query(_MARKERS + """r(rule_id, priority, a, la, b, lb, ab, action) as (values (1, 5, 'Brand#1', 25.0, 'Brand#2', 25.0, 'Brand#99', 'A'), (2, 9, 'Brand#3', 26.5, 'Brand#4', 20.0, 'Brand#99', 'B'), (3, 7, 'Brand#5', 0.0, 'Brand#6', 0.0, 'Brand#7', 'C'), (4, 1, 'Brand#8', 0.0, 'Brand#9', 0.0, 'Brand#99', 'D')),
 f as (select m."cluster", rule_id, priority, action from mk m join r on m.gene = a and logfc >= la join mk n on n."cluster" = m."cluster" and n.gene = b and n.logfc >= lb
  where not exists (select 1 from mk o where o."cluster" = m."cluster" and o.gene = ab))
 select * from f qualify row_number() over (partition by "cluster" order by priority desc, rule_id) = 1""")
def expert_rules(spark, d):
    """The rule of highest priority that fires for each cluster."""
    rule = "named_struct('rule_id', {}, 'priority', {}, 'present', map('{}', {}D, '{}', {}D), 'absent', array('{}'), 'action', '{}')"
    given = [(1, 5, "Brand#1", 25, "Brand#2", 25, "Brand#99", "A"), (2, 9, "Brand#3", 26.5, "Brand#4", 20, "Brand#99", "B"),
             (3, 7, "Brand#5", 0, "Brand#6", 0, "Brand#7", "C"), (4, 1, "Brand#8", 0, "Brand#9", 0, "Brand#99", "D")]
    rules = spark.sql("select inline(array(" + ", ".join(rule.format(*g) for g in given) + "))")
    return knowledge.fired_rules(_markers(spark, d), rules)


_TOP = _MARKERS + """tp as (select "cluster", gene from mk qualify row_number() over (partition by "cluster" order by round(logfc, 9) desc, gene) <= 10),
 kt as (select distinct "type", gene from mg where n_sources >= 2),
 sc as (select "cluster", "type", count(*) hits, any_value(n_top) n_top, any_value(n_type) n_type, count(*) / sqrt(any_value(n_top) * any_value(n_type)) cosine from tp join kt using (gene)
  join (select "cluster", count(*) n_top from tp group by 1) using ("cluster") join (select "type", count(*) n_type from kt group by 1) using ("type") group by 1, 2)"""


def _scores(spark, d):
    from pyspark.sql import Window

    order = Window.partitionBy("cluster").orderBy(F.desc(F.round("logfc", 9)), "gene")
    top = _markers(spark, d).withColumn("k", F.row_number().over(order)).where("k <= 10").select("cluster", "gene")
    types = knowledge.merge_markers(kb(spark, d)).where("n_sources >= 2").select("type", "gene").distinct()
    return knowledge.score_types(top, types)


@query(_TOP + """ select "cluster", "type", hits, n_top, n_type, round(cosine, 6) cosine, round(cosine * case when n_type > 5 then 1.0 when n_type >= 3 then 0.8 else 0.5 end, 6) score,
 case when hits < 2 and n_type > 20 then 'window_padding' when hits = 0 then 'zero_evidence' when hits = 1 then 'single_marker' when n_type % 2 = 0 then 'multi_marker' else 'weak_multi' end evidence from sc""")
def score_clusters(spark, d):
    """Overlap scores of clusters and types with their confidence and kind of evidence."""
    s = _scores(spark, d)
    level = F.when(F.col("n_type") % 2 == 0, "gold").otherwise("low")
    return _r(s.withColumn("score", F.col("cosine") * knowledge.confidence(F.col("n_type"))).withColumn(
        "evidence", knowledge.evidence_class(F.col("hits"), F.col("n_type"), level)), "cosine", "score")


@query("""c as (select c_custkey k, case when c_mktsegment = 'BUILDING' then null else r_name end source, 'ASIA' target, n_name so, case when c_custkey % 3 = 0 then null else 'NATION_2' end tord, c_custkey % 4 nc
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
 select k, (case when source is null then 0.8 when source = target then case when tord is null or lower(so) = lower(tord) then 1.0 else 0.8 end when nc >= 3 then 0.9 when nc >= 2 then 0.8 else 0.6 end)::double weight from c""")
def phylogenetic_weights(spark, d):
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    source = F.when(F.col("c_mktsegment") != "BUILDING", F.col("r_name"))
    order = F.when(F.col("c_custkey") % 3 != 0, "NATION_2")
    w = knowledge.phylogenetic_weight(source, F.lit("ASIA"), F.col("n_name"), order, F.col("c_custkey") % 4)
    return c.select(F.col("c_custkey").alias("k"), w.alias("weight"))


@query(_TOP + """, p as (select *, case "type" % 3 when 0 then 'progenitor' when 1 then 'terminal' end pole from sc),
 m as (select "cluster", coalesce(max(cosine) filter (pole = 'progenitor'), 0) mp, coalesce(max(cosine) filter (pole = 'terminal'), 0) mt,
  (list({'s': cosine, 't': "type"} order by cosine desc, "type" desc) filter (pole = 'progenitor'))[1].t best from p group by 1)
 select "cluster", best, round(mp, 6) max_prog, round(mt, 6) max_term, round(mp / greatest(mt, 1e-6), 6) ratio, round(mp - mt, 6) + 0.0 gap, mp / greatest(mt, 1e-6) >= 2 passes_ratio, mp - mt >= 0.1 passes_gap, mp >= 0.6 and mp > mt passes_abs from m""")
def potency(spark, d):
    pole = F.when(F.col("type") % 3 == 0, "progenitor").when(F.col("type") % 3 == 1, "terminal")
    out = knowledge.potency(_scores(spark, d).select("cluster", "type", F.col("cosine").alias("score"), pole.alias("pole")))
    return _r(out, "max_prog", "max_term", "ratio", "gap")


@query("""v as (select o_orderkey k, nullif(o_orderstatus, 'P') a, left(o_orderpriority, 1) b, case when o_custkey % 3 = 0 then o_orderstatus end c, case when o_custkey % 2 = 0 then o_orderstatus end e from orders),
 l as (select k, unnest([0, 1, 2, 3]) p, unnest([a, b, c, e]) lab from v), n as (select k, lab, count(*) n, min(p) p from l where lab is not null group by all),
 r as (select k, sum(n)::bigint nv, count(*) nl, list(lab order by n desc, p) s from n group by 1)
 select k, coalesce(nv, 0) n_votes, coalesce(nl, 0) n_labels, case when nv >= 3 then case when nl >= 3 then 'transitional: ' || s[1] || '/' || s[2] when nl = 2 then 'Unknown' else s[1] end end label,
 case when nv >= 3 then case when nl >= 3 then 'divergent' when nl = 2 then 'two_way' else 'consensus' end end reason from v left join r using (k)""", prelude="with ")
def vote_arbitration(spark, d):
    status = F.col("o_orderstatus")
    votes = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"), F.nullif(status, F.lit("P")).alias("marker"), F.substring("o_orderpriority", 1, 1).alias("expert"),
        F.when(F.col("o_custkey") % 3 == 0, status).alias("ai"), F.when(F.col("o_custkey") % 2 == 0, status).alias("celltypist"),
    )
    return knowledge.arbitrate(votes, "k")


@query("""s as (select "sample" "cluster", "type", sc from (select c_nationkey "sample", c_mktsegment "type", round(avg(c_acctbal) / 10000, 6) sc from customer group by all)),
 k as (select *, row_number() over (partition by "cluster" order by sc desc, "type") k from s),
 t as (select "cluster", max("type") filter (k = 1) t1, max(sc) filter (k = 1) s1, max("type") filter (k = 2) t2, max(sc) filter (k = 2) s2 from k group by 1),
 j as (select *, "cluster" % 7 = 0 low, case when "cluster" % 5 = 0 then 'Rule_type' end act from t)
 select "cluster", case when low then 'Low_quality' when act is not null then act when s1 < 0.25 then 'Unknown' when s1 - s2 <= 0.02 then least(t1, t2) || '/' || greatest(t1, t2) else t1 end label,
 case when low then 'low' when act is not null then 'high' when s1 < 0.25 then 'unknown' when s1 - s2 <= 0.02 then 'transition' when s1 >= 0.7 then 'high' when s1 >= 0.5 then 'medium' when s1 >= 0.25 then 'low' else 'unknown' end confidence,
 case when low then 'quality' when act is not null then 'rule' when s1 < 0.25 then 'none' when s1 - s2 <= 0.02 then 'transition' else 'score' end "method" from j""", prelude="with ")
def evidence_fusion(spark, d):
    c = table(spark, d, "customer")
    scores = c.groupBy(F.col("c_nationkey").alias("cluster"), F.col("c_mktsegment").alias("type")).agg(F.round(F.avg("c_acctbal") / 10000, 6).alias("score"))
    keys = c.select(F.col("c_nationkey").alias("cluster")).distinct()
    rules = keys.where("cluster % 5 = 0").withColumn("action", F.lit("Rule_type"))
    return knowledge.fuse(scores, rules, keys.where("cluster % 7 = 0"), near=0.02)


@query("""recursive w as (select type_key, type_key root, 0 depth from kb_type union all select w.type_key, t.parent, depth + 1 from w join kb_type t on t.type_key = w.root where t.parent in (select type_key from kb_type))
 select type_key, arg_max(root, depth) root, max(depth)::int depth from w group by 1""", prelude="with ")
def type_ancestors(spark, d):
    return knowledge.ancestors(table(spark, d, "kb_type"))


_GRID = """gr as (select s_nationkey % 5 n_neighbors, s_suppkey / 10.0 resolution, 2 + (s_suppkey * 7) % 23 n_clusters, round(s_acctbal / 10000, 4) silhouette, round(((s_suppkey * 37) % 101) / 101.0, 4) stability, (s_suppkey * 13) % 60 min_de from supplier)
"""


def _grid(spark, d):
    s = table(spark, d, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        (F.col("s_nationkey") % 5).alias("n_neighbors"), (k / 10.0).alias("resolution"), (2 + (k * 7) % 23).alias("n_clusters"),
        F.round(F.col("s_acctbal") / 10000, 4).alias("silhouette"), F.round(((k * 37) % 101) / 101.0, 4).alias("stability"), ((k * 13) % 60).alias("min_de"),
    )


@query(_GRID + """ select n_neighbors, resolution, n_clusters, round(greatest(0, (n_clusters - lag(n_clusters) over w) / nullif(resolution - lag(resolution) over w, 0)), 6) splitting_gain
 from gr window w as (partition by n_neighbors order by resolution)""", prelude="with ")
def grid_splitting_gain(spark, d):
    return _r(clusters.splitting_gain(_grid(spark, d)), "splitting_gain").select("n_neighbors", "resolution", "n_clusters", "splitting_gain")


@query(_GRID + """, r as (select *, count(*) over () n, rank() over (order by silhouette) + (count(*) over (partition by silhouette) - 1) / 2.0 a, rank() over (order by stability) + (count(*) over (partition by stability) - 1) / 2.0 b from gr)
 select n_neighbors, resolution, round((0.6 * (a - 1) / (n - 1) + 0.4 * (b - 1) / (n - 1)) / 1.0, 6) composite from r""", prelude="with ")
def grid_composite(spark, d):
    return _r(clusters.composite(_grid(spark, d), {"silhouette": 0.6, "stability": 0.4}), "composite").select("n_neighbors", "resolution", "composite")


@query(_GRID + """, f as (select *, max(silhouette) over (order by n_clusters, silhouette desc rows between unbounded preceding and 1 preceding) b from gr),
 p as (select n_clusters k, silhouette s from f where b is null or s > b), q as (select *, sqrt(pow(1 - (s - min(s) over ()) / (max(s) over () - min(s) over () + 1e-10), 2) + pow((k - min(k) over ()) / (max(k) over () - min(k) over () + 1e-10), 2)) dist from p)
 select k n_clusters, s silhouette, round(dist, 6) distance, row_number() over (order by dist, k) = 1 chosen from q""", prelude="with ")
def grid_pareto(spark, d):
    return _r(clusters.pareto_elbow(_grid(spark, d)), "distance").select("n_clusters", "silhouette", "distance", "chosen")


@query(_GRID + """, o as (select * from gr where n_neighbors = 2) select round(stddev_pop(silhouette) / abs(avg(silhouette)), 6) cv, max(n_clusters) max_k,
 case when stddev_pop(silhouette) / abs(avg(silhouette)) < 0.05 and max(n_clusters) < 10 then 'subtype' else 'major' end granularity from o""", prelude="with ")
def grid_granularity(spark, d):
    return _r(clusters.granularity(_grid(spark, d)), "cv")


@query(_GRID + """ select n_neighbors, resolution, n_clusters, min_de from gr qualify row_number() over (order by (min_de >= 25)::int desc, case when min_de >= 25 then n_clusters else min_de end desc, resolution, n_neighbors) = 1""", prelude="with ")
def grid_gated(spark, d):
    return clusters.gated(_grid(spark, d)).select("n_neighbors", "resolution", "n_clusters", "min_de")


@query("""s as (select c_nationkey "cluster", c_mktsegment "type", avg(c_acctbal) score, count(*) n from customer group by all), z as (select c_nationkey "cluster", count(*) n from customer group by 1 having count(*) >= 10),
 k as (select *, row_number() over (partition by "cluster" order by score desc, "type") k from s), t as (select "cluster", max(score) filter (k = 1) a, max(score) filter (k = 2) b from k group by 1)
 select round(avg((a > 4000 and (b is null or b <= 0 or a / b > 1.05))::int), 6) coherence, count(*) n_clusters from t semi join z using ("cluster")""", prelude="with ")
def cluster_coherence(spark, d):
    c = table(spark, d, "customer")
    scores = c.groupBy(F.col("c_nationkey").alias("cluster"), F.col("c_mktsegment").alias("type")).agg(F.avg("c_acctbal").alias("score"))
    sizes = c.groupBy(F.col("c_nationkey").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return _r(clusters.coherence(scores, sizes, 1.05, 4000.0), "coherence")
