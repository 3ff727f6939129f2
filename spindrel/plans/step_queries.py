"""Queries of exact permutation tests, writing back, summaries, and whole steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.operators import permutations, registry, spatial
from spindrel.plans import network_queries, roles
from spindrel.plans.book import Book
from spindrel.plans.matrix_queries import gene_sets
from spindrel.runtime import table

BOOK = Book(roles.SQL)
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- exact permutation moments

_GRAPH = """sp as (select vec_id id, embedding[1]::double px, embedding[2]::double py, label::bigint label from embeddings),
 eg as (select a.id src, b.id dst from sp a join sp b on a.id <> b.id where sqrt(pow(a.px - b.px, 2) + pow(a.py - b.py, 2)) <= 0.05),
"""


def _spots(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("px"), F.col("embedding")[1].cast("double").alias("py"), F.col("label").cast("bigint").alias("label"))


@query(_GRAPH + """o as (select * from eg where src < dst), nn as (select least(a.label, b.label) a, greatest(a.label, b.label) b, count(*) n from o join sp a on a.id = src join sp b on b.id = dst group by 1, 2), sz as (select label, count(*)::double m from sp group by 1),
 dg as (select src id, count(*)::double d from eg group by 1), g as (select sum(d) / 2 e, sum(d * (d - 1)) / 2 c2, (select count(*)::double from sp) t from dg),
 p as (select x.label a, y.label b, x.m na, y.m nb, e, c2, t, case when x.label = y.label then x.m * (x.m - 1) else 2 * x.m * y.m end / (t * (t - 1)) p1, case when x.label = y.label then x.m * (x.m - 1) * (x.m - 2) else x.m * y.m * (x.m + y.m - 2) end / (t * (t - 1) * (t - 2)) p2,
  case when x.label = y.label then x.m * (x.m - 1) * (x.m - 2) * (x.m - 3) else 4 * x.m * (x.m - 1) * y.m * (y.m - 1) end / (t * (t - 1) * (t - 2) * (t - 3)) p3 from sz x join sz y on x.label <= y.label, g)
 select a, b, coalesce(n, 0) n, round(e * p1, 6) expected, round((coalesce(n, 0) - e * p1) / sqrt(e * p1 + 2 * c2 * p2 + 2 * (e * (e - 1) / 2 - c2) * p3 - e * p1 * e * p1), 6) + 0.0 z from p left join nn using (a, b)""", prelude="with ")
def contact_enrichment(spark, d):
    """Edges between labels against all ways to hand the labels out."""
    s = _spots(spark, d)
    return _r(permutations.contact_enrichment(spatial.radius_graph(s, 0.05), s.select("id", "label")), "expected", "z")


@query(_GRAPH + """v as (select id, 'label' feature, label::double v from sp union all select id, 'px', px from sp), z as (select id, feature, v - avg(v) over (partition by feature) z from v), o as (select feature, count(*)::double n, sum(z * z) m2, sum(z ** 4) m4 from z group by 1),
 c as (select a.feature, sum(a.z * b.z) num from eg join z a on a.id = src join z b on b.id = dst and b.feature = a.feature group by 1), w as (select count(*)::double s0, count(*)::double * 4 / 2 s1 from eg), s2 as (select sum(4 * d * d) s2 from (select src, count(*)::double d from eg group by 1)),
 q as (select feature, n, n * num / (s0 * m2) i, -1 / (n - 1) e, n * m4 / (m2 * m2) k, s0, s1, s2 from o join c using (feature), w, s2)
 select feature, round(i, 6) + 0.0 moran, round(e, 6) expected, round((i - e) / sqrt((n * ((n * n - 3 * n + 3) * s1 - n * s2 + 3 * s0 * s0) - k * ((n * n - n) * s1 - 2 * n * s2 + 6 * s0 * s0)) / ((n - 1) * (n - 2) * (n - 3) * s0 * s0) - e * e), 5) + 0.0 z from q""", prelude="with ")
def autocorrelation_test(spark, d):
    s = _spots(spark, d)
    values = s.select("id", F.lit("px").alias("feature"), F.col("px").alias("v")).unionByName(s.select("id", F.lit("label").alias("feature"), F.col("label").cast("double").alias("v")))
    out = permutations.moran_test(values, spatial.radius_graph(s, 0.05).select("src", "dst", F.lit(1.0).alias("w")))
    return _r(_r(out, "moran", "expected"), "z", digits=5)


@query("""pr(ligand, receptor) as (values ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#4'), ('Brand#5', 'Brand#5')), tt as (select count(*)::double t from obs), sz as (select "cluster" grp, count(*)::double n from obs group by 1),
 ow as (select x.cell_id, gene_id gene, "value"::double v, "cluster" grp from x join obs using (cell_id) where gene_id in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')), wh as (select gene, sum(v) s, sum(v * v) q from ow group by 1), pg as (select grp, gene, sum(v) s from ow group by 1, 2),
 dt as (select l.gene ligand, r.gene receptor, sum(l.v * r.v) dot from ow l join ow r using (cell_id) group by 1, 2),
 b as (select pr.ligand, pr.receptor, a.grp source, c.grp target, a.n n1, c.n n2, t, wl.s sl, wr.s sr, (wl.q - wl.s * wl.s / t) / (t - 1) vl, (wr.q - wr.s * wr.s / t) / (t - 1) vr, (coalesce(dot, 0) - wl.s * wr.s / t) / (t - 1) c,
  (coalesce(gl.s, 0) / a.n + coalesce(gr.s, 0) / c.n) / 2 m from pr join wh wl on wl.gene = pr.ligand join wh wr on wr.gene = pr.receptor left join dt on dt.ligand = pr.ligand and dt.receptor = pr.receptor cross join sz a cross join sz c cross join tt
  left join pg gl on gl.gene = pr.ligand and gl.grp = a.grp left join pg gr on gr.gene = pr.receptor and gr.grp = c.grp)
 select ligand, receptor, source, target, round(m, 6) lr_mean, round((m - (sl / t + sr / t) / 2) / sqrt((vl / n1 * (1 - n1 / t) + vr / n2 * (1 - n2 / t) + 2 * case when source = target then c / n1 * (1 - n1 / t) else -c / t end) / 4), 5) + 0.0 z from b""")
def interaction_test(spark, d):
    """Ligand and receptor means of two groups against all ways to hand the groups out."""
    pairs = spark.sql("select * from values ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#4'), ('Brand#5', 'Brand#5') as t(ligand, receptor)")
    labels = roles.cells(spark, d).select("cell_id", F.col("cluster").alias("grp"))
    out = permutations.interaction_test(roles.counts(spark, d).withColumnRenamed("gene_id", "gene"), labels, pairs)
    return _r(_r(out, "lr_mean"), "z", digits=5)


# --- writing back


@query("""dc as (select leiden, max(cell_type_std) t from obs_annotated where leiden in ('0', '1', '3') and cell_type_std is not null group by 1) select coalesce(t, cell_type_std) cell_type_std, count(*) n from obs_annotated left join dc using (leiden) group by 1""", prelude="with ")
def written_labels(spark, d):
    """Cells by label, after decisions for some clusters are written back."""
    o = table(spark, d, "obs_annotated").select("row_id", "leiden", "cell_type_std")
    dec = o.where("leiden in ('0', '1', '3') and cell_type_std is not null").groupBy("leiden").agg(F.max("cell_type_std").alias("cell_type_std"))
    return registry.written_back(o, dec, "leiden", ["cell_type_std"]).groupBy("cell_type_std").agg(F.count(F.lit(1)).alias("n"))


@query("""p(c, o, w, n) as (values ('0', 'high', 'checked', 1), ('0', 'high', 'sure', 2), ('1', null, 'all of 1', 3), ('1', 'low', 'early', 1), ('1', 'medium', 'late', 4))
 select case when leiden = '1' and annot_confidence = 'medium' then 'late' when leiden = '1' then 'all of 1' when leiden = '0' and annot_confidence = 'high' then 'sure' else annot_confidence end as "label", count(*) n from obs_annotated group by 1""", prelude="with ")
def patched_labels(spark, d):
    """Labels after a list of patches, of which later ones count."""
    p = spark.sql("select * from values ('0', 'high', 'checked', 1), ('0', 'high', 'sure', 2), ('1', null, 'all of 1', 3), ('1', 'low', 'early', 1), ('1', 'medium', 'late', 4) as t(cluster, old, new, n)")
    o = table(spark, d, "obs_annotated").select("row_id", "leiden", F.col("annot_confidence").alias("label"))
    return registry.patched(o, p, "leiden", "label").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("""o as (select type_key, display_name, tier from kb_type where ascii(type_key) % 3 > 0), n as (select type_key, case when ascii(type_key) % 2 = 0 then upper(display_name) end display_name from kb_type where ascii(type_key) % 5 < 3)
 select type_key, coalesce(n.display_name, o.display_name) display_name, tier from o full join n using (type_key)""", prelude="with ")
def upserted_types(spark, d):
    """A registry's rows after an update."""
    t, code = table(spark, d, "kb_type"), F.ascii("type_key")
    new = t.where(code % 5 < 3).select("type_key", F.when(code % 2 == 0, F.upper("display_name")).alias("display_name"))
    return registry.upserted(t.where(code % 3 > 0).select("type_key", "display_name", "tier"), new, ["type_key"])


@query("""n as (select n_nationkey::varchar as "key", n_name, r_name, case when n_nationkey % 2 = 0 then n_regionkey end k from nation join region on r_regionkey = n_regionkey) select "key", '{"n_name":"' || n_name || '","r_name":"' || r_name || '"' || case when k is null then '' else ',"k":' || k end || '}' json from n""", prelude="with ")
def exported_json(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return registry.as_json(n.select("n_nationkey", "n_name", "r_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).alias("k")), "n_nationkey")


def _key(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(f"""p as (select distinct paper_id, first_author a, pub_year y, title t from paper_entry), k as (select paper_id, {_key("case when contains(a, ',') then string_split(a, ',')[1] else string_split(regexp_replace(trim(a), '\\s+', ' ', 'g'), ' ')[-1] end")} ka, nullif(regexp_extract(y, '(\\d{{4}})', 1), '') ky,
 array_to_string(list_filter(string_split({_key('t')}, '_'), lambda w: length(w) > 3)[1:3], '_') kt from p) select paper_id, concat_ws('_', nullif(ka, ''), ky, nullif(kt, '')) slug, count(*) n from k group by 1, 2""", prelude="with ")
def paper_slugs(spark, d):
    """Names of papers by first author, year and topic."""
    p = table(spark, d, "paper_entry").select("paper_id", "first_author", "pub_year", "title").distinct()
    out = p.select("paper_id", registry.slug(F.col("first_author"), F.col("pub_year"), F.col("title")).alias("slug"))
    return out.groupBy("paper_id", "slug").agg(F.count(F.lit(1)).alias("n"))


# --- summaries and choices


@query("""m as (select row_id node, dataset_id component, case when annot_confidence in ('high', 'medium') then cell_type_std end lb from obs_annotated where dataset_id is not null), n as (select component, count(*) n from m group by 1 having count(*) >= 2), k as (select component, lb, count(*) k from m where lb is not null group by 1, 2),
 t as (select * from k qualify row_number() over (partition by component order by k desc, lb) = 1) select component, n, lb as "label", round(k / n, 6) purity, case when lb is null then 'novel' when k / n >= 0.5 then 'known' else 'mixed' end kind from n left join t using (component)""", prelude="with ")
def community_summary(spark, d):
    """Commonest label and purity of groups of cells."""
    o = table(spark, d, "obs_annotated").where("dataset_id is not null")
    members = o.select(F.col("row_id").alias("node"), F.col("dataset_id").alias("component"))
    labels = o.select(F.col("row_id").alias("node"), F.when(F.col("annot_confidence").isin("high", "medium"), F.col("cell_type_std")).alias("label"))
    return _r(registry.community_summary(members, labels).select("component", "n", "label", "purity", "kind"), "purity")


@query("""ad as (select lower(n_name) s, lower('NATION_' || (n_nationkey * 7 + 1) % 25) t, r_name kind from nation join region on n_regionkey = r_regionkey), pr as (select n_name source, 'nation_' || (n_nationkey * k + 1) % 25 target from nation cross join (values (7), (3), (18)) v(k)),
 j as (select p.source, p.target, coalesce(f.kind, b.kind) kind from pr p left join ad f on f.s = lower(p.source) and f.t = lower(p.target) left join ad b on b.t = lower(p.source) and b.s = lower(p.target)) select source, target, kind from j where kind in ('ASIA', 'EUROPE', 'AFRICA')""", prelude="with ")
def allowed_contacts(spark, d):
    """Pairs whose contact is of an allowed kind."""
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    other = lambda k, word: F.concat(F.lit(word), ((F.col("n_nationkey") * k + 1) % 25).cast("string"))
    adjacency = nation.select(F.col("n_name").alias("source"), other(7, "NATION_").alias("target"), F.col("r_name").alias("kind"))
    pairs = nation.select(F.col("n_name").alias("source"), F.explode(F.array(*[other(k, "nation_") for k in (7, 3, 18)])).alias("target"))
    return registry.by_contact(pairs, adjacency, "hard", ["ASIA", "EUROPE", "AFRICA"])


@query("""g as (select s_nationkey % 5 n_neighbors, s_suppkey / 10.0 resolution, 2 + (s_suppkey * 7) % 23 n_clusters, round(s_acctbal / 10000, 4) silhouette from supplier) select n_neighbors, resolution, n_clusters, silhouette from g order by silhouette desc, n_clusters, resolution, n_neighbors limit 1""", prelude="with ")
def best_grid_point(spark, d):
    s, k = table(spark, d, "supplier"), F.col("s_suppkey")
    grid = s.select((F.col("s_nationkey") % 5).alias("n_neighbors"), (k / 10.0).alias("resolution"), (2 + (k * 7) % 23).alias("n_clusters"), F.round(F.col("s_acctbal") / 10000, 4).alias("silhouette"))
    return registry.best_setting(grid)


@query("""t as (select cell_id, sum("value") s from x group by 1), f as (select gene_id, count(*) df from x group by 1), n as (select count(distinct cell_id) n from x) select cell_id, gene_id, round(ln(1 + "value" / s * n / df * 1e4), 5) as "value" from x join t using (cell_id) join f using (gene_id), n""")
def peak_tfidf(spark, d):
    """Term frequency times inverse cell frequency of every stored value."""
    return _r(registry.tfidf(roles.counts(spark, d)), "value", digits=5)


@query("""t as (select cell_id, sum("value") s from x group by 1), m as (select max("value") mx from x) select gene_id, round(sum(case when mx > 50 then ln(1 + "value" * 1e4 / s) else "value" end), 3) total from x join t using (cell_id), m group by 1""")
def normalised_if_raw(spark, d):
    return _r(registry.normalised_if_raw(roles.counts(spark, d)).groupBy("gene_id").agg(F.sum("value").alias("total")), "total", digits=3)


# --- steps


@query("""m as (select cell_id, sum("value") total from x group by 1), md as (select median(total) md from m), de as (select median(abs(total - md)) * 1.482602218505602 mad from m, md), k as (select cell_id from m, md, de where total between md - 2 * mad and md + 2 * mad),
 r as (select x.* from x semi join k using (cell_id)), g as (select gene_id from r group by 1 having count(*) >= 50) select gene_id, count(*) n_cells, sum("value") total from r semi join g using (gene_id) group by 1""")
def quality_step(spark, d):
    """Quality control from metrics to the filtered matrix, by gene."""
    out = registry.quality_step(roles.counts(spark, d), *gene_sets(), column="total", k=2, min_cells=50, top=2)
    return out.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_cells"), F.sum("value").alias("total"))


@query("""pw as (select p_brand || ' ' || p_type term, p_type kind, min(p_retailprice) / 100000 p_adj, list(distinct p_name) genes from part group by all), re as (select term, kind, p_adj, -log10(greatest(p_adj, 1e-300)) * (1 + len(list_filter(genes, lambda g: g in ('red widget', 'small ring', 'blue bolt'))) / len(genes)) relevance from pw),
 f as (select term, kind, relevance, contains(lower(term), 'brand#2') al, contains(lower(term), 'economy') de, (relevance - min(relevance) over ()) / (max(relevance) over () - min(relevance) over ()) s from re), m as (select median(s) v from f where not al and not de)
 select term, round(relevance, 6) relevance, round(case when al then 1.0::double else s end, 6) tissue_score from f, m where al or (not de and s > v and s > 0)""", prelude="with ")
def enrichment_step(spark, d):
    """Relevance, redundancy and tissue in their order; the threshold of likeness is above 1, so that no term is dropped here."""
    out = registry.enrichment_step(network_queries._pathways(spark, d), "kind", network_queries.MARKERS, ["brand#2"], ["economy"], similarity=1.1)
    return _r(out, "relevance", "tissue_score").select("term", "relevance", "tissue_score")


@query("""m as (select dataset_id, group_label, upper(names) gene, max(scores) s from marker_gene where dataset_id is not null and names is not null and scores is not null and not isnan(scores) group by all)
 select dataset_id, count(distinct group_label) n_groups, count(distinct gene) n_genes, round(max(s), 4) best, arg_max(gene, struct_pack(s := s, g := gene)) best_gene from m group by 1""", prelude="with ")
def marker_summary(spark, d):
    """Groups, genes and the best gene of each data set."""
    m = table(spark, d, "marker_gene").where("dataset_id is not null and names is not null and scores is not null and not isnan(scores)")
    m = m.groupBy("dataset_id", "group_label", F.upper("names").alias("gene")).agg(F.max("scores").alias("s"))
    best = F.max(F.struct("s", "gene"))
    return m.groupBy("dataset_id").agg(F.count_distinct("group_label").alias("n_groups"), F.count_distinct("gene").alias("n_genes"), F.round(F.max("s"), 4).alias("best"), best["gene"].alias("best_gene"))


@query(r"""f as (select regexp_extract(path, 'papers/([^/]+)/', 1) dataset, kind, deleted_at from artifact where path is not null) select dataset, count(*) n_files, count(*) filter (deleted_at is null) n_live, count(distinct kind) n_kinds from f where dataset <> '' group by 1""", prelude="with ")
def dataset_files(spark, d):
    """Files of each folder that their paths name."""
    f = table(spark, d, "artifact").where("path is not null").select(F.regexp_extract("path", r"papers/([^/]+)/", 1).alias("dataset"), "kind", "deleted_at").where("dataset <> ''")
    return f.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("deleted_at").isNull()).alias("n_live"), F.count_distinct("kind").alias("n_kinds"))
