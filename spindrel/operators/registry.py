"""Labels and metadata that are written back, summaries of results, names of papers, groups of files; whole steps put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.functions.text import label_key
from spindrel.operators import matrix, network, quality


def written_back(cells: DataFrame, decisions: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Cells with the decided columns of their cluster; cells of clusters without a decision keep what they have."""
    d = decisions.select(F.col(cluster).alias("__c"), *[F.col(c).alias(f"__{c}") for c in columns])
    j = cells.join(d, F.col(cluster).eqNullSafe(F.col("__c")), "left")
    new = {c: F.coalesce(f"__{c}", *([c] if c in cells.columns else [])) for c in columns}
    return j.withColumns(new).drop("__c", *[f"__{c}" for c in columns])


def patched(cells: DataFrame, patches: DataFrame, cluster: str, label: str) -> DataFrame:
    """Cells with labels changed by ``patches(cluster, old, new, n)``, in order of ``n``: the last patch of a cluster whose ``old`` is the label, or null, counts."""
    order = Window.partitionBy("__c", "__old").orderBy(F.desc("n"))
    p = patches.select(F.col("cluster").alias("__c"), F.col("old").alias("__old"), F.col("new").alias("__new"), "n").withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")
    own = p.where("__old is not null").select("__c", "__old", F.col("__new").alias("__a"), F.col("n").alias("__na"))
    any_ = p.where("__old is null").select(F.col("__c").alias("__d"), F.col("__new").alias("__b"), F.col("n").alias("__nb"))
    j = cells.join(own, (F.col(cluster) == F.col("__c")) & (F.col(label) == F.col("__old")), "left").join(any_, F.col(cluster) == F.col("__d"), "left")
    later = F.col("__a").isNull() | (F.coalesce("__nb", F.lit(-1)) > F.col("__na"))
    new = F.when(F.col("__b").isNotNull() & later, F.col("__b")).when(F.col("__a").isNotNull(), F.col("__a")).otherwise(F.col(label))
    return j.withColumn(label, new).drop("__c", "__d", "__old", "__a", "__b", "__na", "__nb")


def upserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``old`` with the fields that ``new`` has and are not null, and the rows of ``new`` that ``old`` lacks."""
    fields = [c for c in old.columns if c not in key]
    n = new.select(*key, *[F.col(c).alias(f"__{c}") for c in fields if c in new.columns])
    j = old.join(n, key, "full")
    return j.select(*key, *[F.coalesce(f"__{c}", c).alias(c) if c in new.columns else F.col(c) for c in fields])


def as_json(df: DataFrame, key: str) -> DataFrame:
    """``key, json``: each row as an object, null fields left out."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("json"))


def author_key(name: Column) -> Column:
    """Family name of a first author: what is before a comma, else the last word, as a key."""
    return label_key(F.when(name.contains(","), F.split(name, ",")[0]).otherwise(F.element_at(F.split(F.trim(name), r"\s+"), -1)))


def slug(author: Column, year: Column, title: Column, words: int = 3) -> Column:
    """``author_year_topic`` of a paper; the topic are the first words of the title of more than three letters, missing parts are left out."""
    topic = F.array_join(F.slice(F.filter(F.split(label_key(title), "_"), lambda w: F.length(w) > 3), 1, words), "_")
    year_ = F.nullif(F.regexp_extract(year, r"(\d{4})", 1), F.lit(""))
    return F.concat_ws("_", F.nullif(author_key(author), F.lit("")), year_, F.nullif(topic, F.lit("")))


def community_summary(members: DataFrame, labels: DataFrame, least_groups: int = 2) -> DataFrame:
    """Each community's size, commonest label with its share, and whether it is known, mixed or new.

    ``members(node, component)``, ``labels(node, label)`` with null for unknown ones. Labels of less than half make it mixed.
    """
    j = members.join(labels, "node", "left")
    n = j.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("n_labelled")).where(F.col("n") >= least_groups)
    per = j.where("label is not null").groupBy("component", "label").agg(F.count(F.lit(1)).alias("k"))
    order = Window.partitionBy("component").orderBy(F.desc("k"), "label")
    top = per.withColumn("r", F.row_number().over(order)).where("r = 1").select("component", "label", "k")
    out = n.join(top, "component", "left").withColumn("purity", F.col("k") / F.col("n"))
    kind = F.when(F.col("label").isNull(), "novel").when(F.col("purity") >= 0.5, "known").otherwise("mixed")
    return out.select("component", "n", "label", "purity", kind.alias("kind"))


def by_contact(pairs: DataFrame, adjacency: DataFrame, mode: str, kinds: list[str] | None = None) -> DataFrame:
    """Interactions with the kind of contact: ``off`` leaves all, ``soft`` marks them, ``hard`` keeps those with an allowed contact."""
    if mode == "off":
        return pairs.withColumn("kind", F.lit(None).cast("string"))
    out = network.adjacency_matches(pairs, adjacency)
    return out if mode == "soft" else out.where(F.col("kind").isin(kinds) if kinds else F.col("kind").isNotNull())


def best_setting(grid: DataFrame, neighbours: int | None = None, resolution: float | None = None) -> DataFrame:
    """The given grid point, else the one with the best silhouette; ties by fewer clusters, then resolution."""
    rows = grid
    if neighbours is not None:
        rows = rows.where(F.col("n_neighbors") == neighbours)
    if resolution is not None:
        rows = rows.where(F.col("resolution") == resolution)
    order = Window.orderBy(F.desc_nulls_last("silhouette"), "n_clusters", "resolution", "n_neighbors")
    return rows.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")


def tfidf(x: DataFrame, scale: float = 1e4) -> DataFrame:
    """Log of term frequency times inverse cell frequency of peaks: ``log1p(value / total * cells / cells with the peak * scale)``."""
    v = F.col("value").cast("double")
    cells = x.agg(F.count_distinct("cell_id").alias("__n"))
    df = x.groupBy("gene_id").agg(F.count(F.lit(1)).alias("__df"))
    total = F.sum(v).over(Window.partitionBy("cell_id"))
    j = x.withColumn("__t", total).join(df, "gene_id").crossJoin(F.broadcast(cells))
    return j.select("cell_id", "gene_id", F.log1p(v / F.col("__t") * F.col("__n") / F.col("__df") * scale).alias("value"))


def normalised_if_raw(x: DataFrame, most: float = 50.0) -> DataFrame:
    """Log-normalised values if the greatest is above ``most``, else the values as they are."""
    top = x.agg(F.coalesce(F.max("value"), F.lit(0.0)).alias("__max"))
    total = F.sum(F.col("value").cast("double")).over(Window.partitionBy("cell_id"))
    scaled = F.log1p(F.col("value").cast("double") * 1e4 / F.when(total == 0, 1.0).otherwise(total))
    return x.crossJoin(F.broadcast(top)).withColumn("value", F.when(F.col("__max") > most, scaled).otherwise(F.col("value"))).drop("__max")


def quality_step(x: DataFrame, mt: Column, ribo: Column, column: str, k: float, min_cells: int, top: int = 20) -> DataFrame:
    """Metrics, limits from the median, kept cells and then genes: the matrix after quality control."""
    metrics = matrix.cell_metrics(x, mt, ribo, top)
    limits = quality.mad_limits(metrics, column, k)
    kept = metrics.crossJoin(F.broadcast(limits)).where(F.col(column).between(F.col("low"), F.col("high"))).select("cell_id")
    return quality.keep_genes(x, kept, min_cells)


def enrichment_step(pathways: DataFrame, by: str, markers: list[str], allow: list[str], deny: list[str], similarity: float = 0.6) -> DataFrame:
    """Relevance to the markers, one leader for terms that are alike, and those that the tissue allows, in this order."""
    relevant = network.pathway_relevance(pathways, markers)
    leaders = network.redundant_terms(relevant, by, similarity)
    only = relevant.join(leaders.where("term = leader").select(by, "term"), [by, "term"], "left_semi")
    return network.tissue_filter(only, allow, deny).where("kept")
