"""Queries on the embeddings. The query set of searches are the vectors whose id is divisible by 20."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.operators import embedding
from spindrel.plans.book import Book
from spindrel.runtime import table

_E = """e as (select vec_id id, embedding::double[] vec, label from embeddings), qy as (select * from e where id % 20 = 0),
nn as (select q.id "query", e.id, list_distance(q.vec, e.vec) distance from qy q join e on e.id <> q.id qualify row_number() over (partition by q.id order by list_distance(q.vec, e.vec), e.id) <= 10),
"""
BOOK = Book("with " + _E)
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def vectors(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").cast("bigint").alias("label"))


def _near(spark, d, k: int = 10) -> DataFrame:
    v = vectors(spark, d)
    return embedding.nearest(v, v.where("id % 20 = 0"), k)


@query("""z as (select 1) select "query", id, round(distance, 6) distance, row_number() over (partition by "query" order by distance, id) as rank from nn""")
def nearest_vectors(spark, d):
    """The ten nearest vectors of each query vector."""
    return _r(_near(spark, d), "distance").withColumn("rank", F.col("rank").cast("bigint"))


@query("""v as (select "query", label, count(*) n from nn join e using (id) group by 1, 2) select "query", label, round(n / 10, 6) share from v qualify row_number() over (partition by "query" order by n desc, label) = 1""")
def transferred_labels(spark, d):
    """The label that each query vector's neighbours vote for."""
    return _r(embedding.transferred(_near(spark, d), vectors(spark, d)), "share")


_EDGES = """ed as (select "query" src, id dst from nn union select id, "query" from nn),
"""


def _edges(spark, d) -> DataFrame:
    n = _near(spark, d)
    return n.select(F.col("query").alias("src"), F.col("id").alias("dst")).unionByName(n.select(F.col("id").alias("src"), F.col("query").alias("dst"))).distinct()


@query(_EDGES + """l1 as (select src node, dst label from (select src, dst, count(*) n from ed group by 1, 2) qualify row_number() over (partition by src order by n desc, dst) = 1),
 l2 as (select src node, label from (select src, label, count(*) n from ed join l1 on node = dst group by 1, 2) qualify row_number() over (partition by src order by n desc, label) = 1),
 l3 as (select src node, label from (select src, label, count(*) n from ed join l2 on node = dst group by 1, 2) qualify row_number() over (partition by src order by n desc, label) = 1) select node, label from l3""")
def propagated_labels(spark, d):
    """Labels after three rounds over the graph of neighbours."""
    return embedding.propagated(_edges(spark, d), 3)


@query(_EDGES + """n as (select a.label a, b.label b, count(*) n from ed join e a on a.id = src join e b on b.id = dst group by 1, 2)
 select a, b, n, round(n * sum(n) over () / (sum(n) over (partition by a) * sum(n) over (partition by b)), 6) connectivity from n qualify a <> b""")
def group_connections(spark, d):
    return _r(embedding.group_connections(_edges(spark, d), vectors(spark, d)), "connectivity")


@query("""dd as (select a.id, a.label, b.label bl, sum(list_distance(a.vec, b.vec)) s, count(*) n from e a join e b on true group by all), sz as (select label, count(*) c from e group by 1),
 p as (select id, dd.label, max(s) filter (bl = dd.label) / nullif(max(c) - 1, 0) a, min(s / n) filter (bl <> dd.label) b from dd join sz on sz.label = dd.label group by 1, 2)
 select label, count(*) n, round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) silhouette from p group by 1""")
def label_silhouettes(spark, d):
    """Mean silhouette of each label."""
    s = embedding.silhouette(vectors(spark, d))
    return _r(s.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette")), "silhouette")


@query("""o as (select row_id, leiden a, batch b, lower(annot_confidence) c from obs_annotated where leiden is not null and batch is not null and annot_confidence is not null), r as (select row_id, unnest(['a', 'b', 'c']) run, unnest([a, b, c]) l from o),
 cl as (select x.run a, y.run b, x.l la, y.l lb, count(*)::double n from r x join r y using (row_id) where x.run < y.run group by all), s as (select a, b, sum(n * (n - 1) / 2) s, sum(n) * (sum(n) - 1) / 2 t from cl group by all),
 sa as (select a, b, sum(n * (n - 1) / 2) sa from (select a, b, la, sum(n) n from cl group by all) group by all), sb as (select a, b, sum(n * (n - 1) / 2) sb from (select a, b, lb, sum(n) n from cl group by all) group by all)
 select a, b, round((s - sa * sb / t) / ((sa + sb) / 2 - sa * sb / t), 6) ari from s join sa using (a, b) join sb using (a, b)""", prelude="with ")
def labelling_stability(spark, d):
    """Agreement of every two of three labellings of the cells."""
    o = table(spark, d, "obs_annotated").where("leiden is not null and batch is not null and annot_confidence is not null")
    o = o.select(F.col("row_id").alias("id"), F.col("leiden").alias("a"), F.col("batch").alias("b"), F.lower("annot_confidence").alias("c"))
    return _r(embedding.stability(o.unpivot(["id"], ["a", "b", "c"], "run", "label")), "ari")


@query()
def principal_components(spark, d):
    """Shares of the variance of the first components; held against a dense decomposition in the tests."""
    _, shares = embedding.components(vectors(spark, d), 5)
    return spark.createDataFrame([(i + 1, round(s, 6)) for i, s in enumerate(shares)], "component int, share double")


@query()
def neighbour_grid(spark, d):
    """Clusterings for some numbers of neighbours and rounds; its parts have SQL of their own."""
    found = embedding.grid_search(vectors(spark, d), _near(spark, d), [3, 10], [1, 3])
    return spark.createDataFrame([(r["n_neighbors"], r["rounds"], r["n_clusters"], round(r["silhouette"], 6)) for r in found], "n_neighbors int, rounds int, n_clusters bigint, silhouette double")
