"""Annotation of clusters: scoring against a knowledge base, quality, tiers, labels and the checks around them.

Clusters and types are joined through the genes they share, so pairs without a common gene cost nothing and have
a score of 0. ``markers(cluster, gene, logfc)`` are the differential genes of each cluster, ``kb(type, gene, n_sources)`` the
positive markers of each type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.functions.text import label_key
from spindrel.operators import stats
from spindrel.operators.knowledge import confidence, consensus, evidence_class
from spindrel.runtime import filled, fold

# Names of genes that say nothing about a type, weights and ranks of levels, limits of decisions.
MITOCHONDRIAL = ("MT-",)
RIBOSOMAL = ("RPL", "RPS", "MRPL", "MRPS")
NON_CODING = r"^(LINC\d|AC\d|AL\d|AP\d|BX\d|FAM\d+[A-Z]|C\d+orf|RP\d+-|CTC-|CTD-|RP11-|XXyac-|LLNLF-|WI2-|XXbac-)"
WEIGHTS = {"gold": 3.0, "high": 2.0, "medium": 1.5, "low": 1.0}
RANKS = {"gold": 4, "high": 3, "medium": 2, "low": 1}
STEPS = (50, 100, 200)
DENSITY = 0.05
LEAST_SCORE = 0.25
CATEGORY = "Broad_"


def _starts(gene: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [gene.startswith(p) for p in prefixes])


def is_noise(gene: Column) -> Column:
    """Mitochondrial, ribosomal and non-coding genes, by name."""
    return _starts(gene, MITOCHONDRIAL) | _starts(gene, RIBOSOMAL) | gene.rlike(NON_CODING)


def ranked(markers: DataFrame) -> DataFrame:
    """``k``: place of each gene in its cluster by falling fold change, then name."""
    return markers.withColumn("k", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc_nulls_last("logfc"), "gene")))


def low_quality(markers: DataFrame, top: int = 20) -> DataFrame:
    """Mitochondrial and ribosomal genes among the first ``top`` of each cluster and why it is of low quality, if it is."""
    first = ranked(markers).where(F.col("k") <= top)
    g = F.col("gene")
    per = first.groupBy("cluster").agg(F.count_if(_starts(g, MITOCHONDRIAL)).alias("n_mt"), F.count_if(_starts(g, RIBOSOMAL)).alias("n_ribo"))
    reason = F.when(F.col("n_mt") >= 3, "mito_high").when(F.col("n_ribo") >= 5, "ribo_high").when(F.col("n_mt") + F.col("n_ribo") >= 6, "mito_ribo_mixed")
    return per.withColumn("reason", reason)


def windows(markers: DataFrame, kb: DataFrame, start: int = 20, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """``cluster, window, hits_window, n_window``: how many genes of each cluster are looked at.

    The window grows by the steps while less than ``DENSITY`` of all known markers are in it and a wider one has more.
    """
    known = kb.select("gene").distinct()
    total = known.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("background"))
    rows = ranked(markers.where(~is_noise(F.col("gene")))).join(known.withColumn("known", F.lit(1)), "gene", "left")
    sizes = (start, *steps)
    counts = [F.sum(F.when(F.col("k") <= n, F.coalesce("known", F.lit(0))).otherwise(0)).alias(f"h{n}") for n in sizes]
    lengths = [F.count_if(F.col("k") <= n).alias(f"n{n}") for n in sizes]
    per = rows.groupBy("cluster").agg(*counts, *lengths).crossJoin(F.broadcast(total))
    now = F.struct(F.lit(start).alias("window"), F.col(f"h{start}").alias("hits"), F.col(f"n{start}").alias("n"))
    for n in steps:
        per = per.withColumn("now", now)
        wider = (F.col("now.hits") / F.col("background") < DENSITY) & (F.col(f"h{n}") > F.col("now.hits"))
        now = F.when(wider, F.struct(F.lit(n).alias("window"), F.col(f"h{n}").alias("hits"), F.col(f"n{n}").alias("n"))).otherwise(F.col("now"))
    per = per.withColumn("now", now)
    return per.select("cluster", "now.window", F.col("now.hits").alias("hits_window"), F.col("now.n").alias("n_window"), "background")


def score_clusters(markers: DataFrame, kb: DataFrame, negatives: DataFrame | None = None, single_source: float = 0.5) -> DataFrame:
    """Each cluster's score for each type of which it has a marker: hypergeometric or cosine, whichever is higher.

    The hypergeometric tail is taken of the markers found among all known ones, counted by their level of support where that
    gives more and stays possible; markers of types with a single source count ``single_source`` of it. The score is
    scaled by how many markers the type has, and halved if two of its negative markers are among the first ten genes.
    """
    w = windows(markers, kb)
    sourced = kb.withColumn("level", consensus(F.col("n_sources")))
    weight = F.coalesce(*[F.when(F.col("level") == k, v) for k, v in WEIGHTS.items()])
    types = kb.groupBy("type").agg(F.count(F.lit(1)).alias("n_type"), (F.max("n_sources") <= 1).alias("single"))
    clean = ranked(markers.where(~is_noise(F.col("gene"))))
    hit = clean.join(w, "cluster").where(F.col("k") <= F.col("window")).join(sourced, "gene").join(types, "type")
    rank = F.coalesce(*[F.when(F.col("level") == k, v) for k, v in RANKS.items()])
    a = hit.groupBy("cluster", "type").agg(
        F.count(F.lit(1)).alias("hits"), F.count_if(F.col("k") <= 20).alias("hits20"), F.max(rank).alias("best"),
        F.bround(F.sum(weight * F.when(F.col("single"), single_source).otherwise(1.0))).cast("bigint").alias("weighted"),
        *[F.max(c).alias(c) for c in ("window", "hits_window", "n_window", "background", "n_type")],
    )
    def tail(n: str) -> Column:
        """P of at least ``n`` markers of the type among the known genes of the window."""
        total = F.greatest(F.col("background"), F.col(n) + (F.col("n_type") - F.col(n)) + (F.col("hits_window") - F.col("hits")) + 1)
        return stats.hypergeometric_tail(F.col(n), F.col("n_type"), F.col(n) + F.col("hits_window") - F.col("hits"), total)

    may = (F.col("weighted") > F.col("hits")) & (F.col("weighted") <= F.col("n_type"))
    a = a.withColumn("p_raw", tail("hits")).withColumn("p_weighted", F.when(may, tail("weighted")))
    use = F.coalesce((F.col("p_weighted") < 0.999) & (F.col("p_weighted") < 1), F.lit(False))
    a = a.withColumn("p", F.when(use, F.col("p_weighted")).otherwise(F.col("p_raw")))
    a = a.withColumn("cosine", F.col("hits") / F.sqrt(F.col("n_window") * F.col("n_type")))
    penalty = F.lit(False)
    if negatives is not None:
        bad = ranked(markers).where("k <= 10").join(negatives.select("type", "gene").distinct(), "gene").groupBy("cluster", "type").agg(F.count(F.lit(1)).alias("n_neg"))
        a = a.join(bad, ["cluster", "type"], "left")
        penalty = F.coalesce(F.col("n_neg") >= 2, F.lit(False))
    a = a.withColumn("penalty", penalty)
    first = 1 - F.col("p") >= F.col("cosine")
    method = F.when(first & use, "hypergeometric_weighted").when(first, "hypergeometric").otherwise("cosine")
    score = F.greatest(1 - F.col("p"), F.col("cosine")) * confidence(F.col("n_type")) * F.when(F.col("penalty"), 0.5).otherwise(1.0)
    level = F.coalesce(*[F.when(F.col("best") == v, k) for k, v in RANKS.items()])
    return a.select(
        "cluster", "type", "hits", "n_type", "window", "p", score.alias("score"), method.alias("method"), "penalty", level.alias("consensus"),
        evidence_class(F.col("hits20"), F.col("window"), level).alias("evidence"),
    )


def best_types(scores: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The type with the highest score of each cluster, ties by name, if it reaches ``least``."""
    order = Window.partitionBy("cluster").orderBy(F.desc("score"), "type")
    return scores.withColumn("__k", F.row_number().over(order)).where((F.col("__k") == 1) & (F.col("score") >= least)).drop("__k")


def tiered(scores: DataFrame, parents: DataFrame, markers: DataFrame, private: DataFrame, delta: float = 0.08, least: float = LEAST_SCORE, floor: str = "medium") -> DataFrame:
    """The best type of each cluster, or a subtype of it that passes three gates.

    ``parents(type, parent)`` has the subtypes; ``private(type, gene, n_sources)`` their own markers. A subtype wins if its score
    is near enough to its parent's and high enough (A), one of its private markers is a gene of the cluster (B), and the
    best level among those is at least ``floor`` (C); of several, the one with the highest score.
    """
    tagged = scores.select("cluster", "type", "score").join(parents.select("type", "parent").distinct(), "type", "left")
    best = best_types(tagged.where("parent is null"), float("-inf")).select("cluster", F.col("type").alias("l2"), F.col("score").alias("l2_score"))
    has = parents.select(F.col("parent").alias("l2"), F.lit(True).alias("divided")).distinct()
    rank = F.coalesce(*[F.when(consensus(F.col("n_sources")) == k, v) for k, v in RANKS.items()])
    held = private.join(markers.select("cluster", "gene").distinct(), "gene").groupBy("cluster", "type").agg(F.count(F.lit(1)).alias("n_private"), F.max(rank).alias("best"))
    subs = tagged.where("parent is not null").join(best, (tagged["parent"] == best["l2"]) & (tagged["cluster"] == best["cluster"])).drop(best["cluster"])
    gates = subs.join(held, ["cluster", "type"], "left").where(
        (F.col("score") >= F.col("l2_score") - delta) & (F.col("score") >= least) & (F.col("n_private") > 0) & (F.col("best") >= RANKS[floor])
    )
    l3 = best_types(gates.select("cluster", "type", "score"), float("-inf")).select("cluster", F.col("type").alias("l3"))
    out = best.join(has, "l2", "left").join(l3, "cluster", "left")
    state = F.when(F.col("l3").isNotNull(), "resolved").when(F.col("divided"), "unresolved").otherwise("na")
    return out.select("cluster", F.coalesce("l3", "l2").alias("label"), F.when(F.col("l3").isNotNull(), "L3").otherwise("L2").alias("tier"), state.alias("resolution"))


def diagnose_unknown(clusters: DataFrame, scores: DataFrame, quality: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Why a cluster has no label: bad data, several types, a weak one, none at all, or unclear."""
    per = scores.groupBy("cluster").agg(F.max("score").alias("top"), F.count_if(F.col("score") >= least).alias("n_high"))
    j = clusters.select("cluster").distinct().join(per, "cluster", "left").join(quality.select("cluster", "reason"), "cluster", "left")
    top = F.coalesce("top", F.lit(0.0))
    category = (
        F.when(F.col("reason").isNotNull(), "low_quality_data").when(F.col("n_high") >= 2, "ambiguous").when((top > 0) & (top < least), "weak_signal")
        .when(top <= 0, "no_kb_match").otherwise("true_unknown")
    )
    return j.select("cluster", category.alias("category"))


def cell_state(method: Column, cell_type: Column, category: Column, level: Column) -> Column:
    """State of a cluster's cells from how its label was found, the label, its category and confidence; first case wins."""
    return (
        F.when(method == "transition_state", "transient_transitional").when(method == "ambiguous", "N/A").when(method == "developmental_potency", "differentiating")
        .when(cell_type.contains("Proliferating"), "cycling").when(category == CATEGORY + "Progenitor", "committed_precursor")
        .when(level.isin("high", "medium") & category.isin(*[CATEGORY + x for x in ("Neuron", "Glia", "Non-neural")]), "terminal").otherwise("N/A")
    )


def harmonised(labels: DataFrame, label: str, types: DataFrame, n_markers: DataFrame) -> DataFrame:
    """``label, type_key``: the entry that an outer label means, by key and by synonym side by side.

    ``types(type_key, synonyms)``, ``n_markers(type_key, n)``. Of several candidates on one way the one with most markers wins, an
    equal number gives none; candidates that differ between the two ways give none.
    """
    given = labels.select(F.col(label).alias("label")).distinct().withColumn("key", label_key(F.col("label"))).where("key <> ''")
    size = types.select("type_key").join(n_markers, "type_key", "left").select("type_key", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
    by_key = types.select("type_key", label_key(F.col("type_key")).alias("key"))
    by_name = types.select("type_key", F.explode("synonyms").alias("s")).select("type_key", label_key(F.col("s")).alias("key"))
    both = by_key.withColumn("way", F.lit("a")).unionByName(by_name.withColumn("way", F.lit("b"))).distinct().join(size, "type_key")
    hits = given.join(both, "key")
    best = F.max(F.struct("n", "type_key"))
    per = hits.groupBy("label", "way").agg(F.sort_array(F.collect_set("type_key")).alias("all"), best.alias("best"), F.max("n").alias("most"), F.collect_list("n").alias("ns"))
    per = per.withColumn("one", F.when(F.size(F.filter("ns", lambda n: n == F.col("most"))) == 1, F.col("best.type_key")))
    of = lambda way, c: F.max(F.when(F.col("way") == way, F.col(c)))
    two = per.groupBy("label").agg(of("a", "all").alias("a"), of("b", "all").alias("b"), of("a", "one").alias("one_a"), of("b", "one").alias("one_b"))
    chosen = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.when(F.col("a") == F.col("b"), F.col("one_a"))).otherwise(F.coalesce("one_a", "one_b"))
    return given.select("label").join(two, "label", "left").select("label", chosen.alias("type_key"))


def standardised(names: DataFrame, name: str, types: DataFrame, ratio: float = 0.85) -> DataFrame:
    """``name, type_key, tier, confidence``: the entry a name means, by the first of six tiers that finds one.

    1: its key; 2: its display name, whatever the letter case; 3: a synonym; 4: one holds the other, from three letters on; 5: the most
    alike by edit distance above ``ratio``; 6: none, and the name stays as it is. Of several, display names go before synonyms,
    then by key. ``types(type_key, display_name, synonyms)``. Names and entries are compared only if they share three letters in a row,
    as all pairs of tiers 4 and 5 do.
    """
    given = names.select(F.col(name).alias("name")).where(filled("name")).distinct().withColumn("low", fold("name"))
    display = types.select("type_key", F.lower("display_name").alias("text"), F.lit(0).alias("kind"))
    synonym = types.select("type_key", F.explode("synonyms").alias("s")).select("type_key", F.lower("s").alias("text"), F.lit(1).alias("kind"))
    keys = types.select("type_key", F.lower("type_key").alias("text"), F.lit(2).alias("kind"))
    entries = display.unionByName(synonym).unionByName(keys).where("text is not null and text <> ''").distinct()
    one = given.join(types.select("type_key").distinct(), F.col("name") == F.col("type_key")).select("name", F.lit(1).alias("tier"), F.lit(0).alias("kind"), F.lit(0.0).alias("miss"), "type_key")
    same = given.join(entries.where("kind < 2"), F.col("low") == F.col("text")).select("name", (F.col("kind") + 2).alias("tier"), "kind", F.lit(0.0).alias("miss"), "type_key")
    rest = given.join(one.unionByName(same).select("name").distinct(), "name", "left_anti").where(F.length("low") >= 3)
    grams = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(c, i, F.lit(3))))).alias("gram")
    near = rest.select("name", "low", grams("low")).join(entries.where(F.length("text") >= 3).select("*", grams("text")), "gram").drop("gram").distinct()
    within = F.col("low").contains(F.col("text")) | F.col("text").contains(F.col("low"))
    four = near.where(within & (F.col("kind") < 2)).select("name", F.lit(4).alias("tier"), "kind", F.lit(0.0).alias("miss"), "type_key")
    miss = F.levenshtein("low", "text") / F.greatest(F.length("low"), F.length("text"))
    five = near.withColumn("miss", miss).where(1 - F.col("miss") > ratio).select("name", F.lit(5).alias("tier"), F.lit(0).alias("kind"), F.round("miss", 9).alias("miss"), "type_key")
    best = F.min(F.struct("tier", "kind", "miss", "type_key"))
    found = one.unionByName(same).unionByName(four).unionByName(five).groupBy("name").agg(best.alias("b"))
    tier = F.coalesce("b.tier", F.lit(6))
    level = F.when(tier <= 3, "high").when(tier <= 5, "medium").otherwise("low")
    return given.join(found, "name", "left").select("name", F.coalesce("b.type_key", "name").alias("type_key"), tier.alias("tier"), level.alias("confidence"))


def category_markers(members: DataFrame, kb: DataFrame, least: int = 3) -> DataFrame:
    """``category, gene, rank``: genes that half of a category's members have, the first 3; else those of 30 %.

    ``members(category, type)``. Genes go by number of members, then by falling name. Fewer than ``least`` give none.
    """
    size = members.groupBy("category").agg(F.countDistinct("type").alias("n_members"))
    counts = members.distinct().join(kb.select("type", "gene").distinct(), "type").groupBy("category", "gene").agg(F.count(F.lit(1)).alias("n")).join(size, "category")
    order = Window.partitionBy("category").orderBy(F.desc("n"), F.desc("gene"))
    k = counts.withColumn("rank", F.row_number().over(order)).withColumn("half", F.col("n") >= F.col("n_members") / 2)
    k = k.withColumn("n_half", F.least(F.count_if("half").over(Window.partitionBy("category")), F.lit(3)))
    third = F.col("n") >= F.col("n_members") * 0.3
    keep = F.when(F.col("n_half") >= least, F.col("half") & (F.col("rank") <= 3)).otherwise(third & (F.col("rank") <= F.least(F.lit(5), F.lit(least))))
    kept = k.where(keep).withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("category"))).where(F.col("m") >= least)
    return kept.select("category", "gene", "rank")


def top_consensus(kb: DataFrame, top: int = 3, least: int = 2) -> DataFrame:
    """The ``top`` markers of each type with at least ``least`` sources, by sources and name."""
    order = Window.partitionBy("type").orderBy(F.desc("n_sources"), "gene")
    return kb.where(F.col("n_sources") >= least).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("type", "gene", "rank")


def expressed_share(fractions: DataFrame, kb: DataFrame) -> DataFrame:
    """Mean share of a cluster's cells that express the markers of a type, of those markers that were measured anywhere.

    ``fractions(cluster, gene, pct)``; a measured gene that a cluster lacks counts 0.
    """
    measured = kb.select("type", "gene").distinct().join(fractions.select("gene").distinct(), "gene")
    size = measured.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    sums = fractions.join(measured, "gene").groupBy("cluster", "type").agg(F.sum(F.col("pct").cast("double")).alias("s"))
    return sums.join(size, "type").select("cluster", "type", (F.col("s") / F.col("n")).alias("score"))


def decisive(scores: DataFrame, least: float = LEAST_SCORE, gap: float = 0.1) -> DataFrame:
    """The best type of each cluster if it reaches ``least`` and is more than ``gap`` ahead of the second; there must be one."""
    order = Window.partitionBy("cluster").orderBy(F.desc("score"), "type")
    k = scores.withColumn("k", F.row_number().over(order)).withColumn("next", F.lead("score").over(order)).where("k = 1 and next is not null")
    return k.where((F.col("score") >= least) & (F.col("score") - F.col("next") > gap)).select("cluster", "type", "score", (F.col("score") - F.col("next")).alias("gap"))


def unsupported(decisions: DataFrame, fractions: DataFrame, kb: DataFrame, floor: float = 0.05) -> DataFrame:
    """Clusters whose label's best supported markers are all expressed by less than ``floor`` of the cells.

    ``decisions(cluster, type)``. Types without such markers, or with none that was measured, are not judged.
    """
    top = top_consensus(kb).select("type", "gene").join(fractions.select("gene").distinct(), "gene")
    pct = decisions.join(top, "type").join(fractions, ["cluster", "gene"], "left")
    return pct.groupBy("cluster", "type").agg(F.max(F.coalesce("pct", F.lit(0.0))).alias("most")).where(F.col("most") < floor).select("cluster", "type")


def broad_category(scores: DataFrame, transitions: bool = False) -> DataFrame:
    """The best category (a type whose name begins with ``CATEGORY``) of each cluster; no progenitors in adult tissue."""
    rows = scores.where(F.col("type").startswith(CATEGORY))
    return best_types(rows if transitions else rows.where(F.col("type") != CATEGORY + "Progenitor"), float("-inf"))


def guarded_category(decisions: DataFrame, parents: DataFrame, transitions: bool = False) -> DataFrame:
    """``decisions(cluster, type, category)`` with the category of the type's own parent, if it has one (``type, category``)."""
    own = parents.select("type", F.col("category").alias("__own"))
    allowed = F.col("__own").isNotNull() & (F.lit(transitions) | (F.col("__own") != CATEGORY + "Progenitor"))
    return decisions.join(own, "type", "left").withColumn("category", F.when(allowed, F.col("__own")).otherwise(F.col("category"))).drop("__own")


def lifted(decisions: DataFrame, roots: DataFrame, parents: DataFrame) -> DataFrame:
    """``cell_type`` and ``subtype`` of each decision: the major type, and the entry below it, ``unresolved`` or ``N/A``.

    ``roots(type_key, root)`` has the ancestors; ``parents(parent)`` those that have subtypes.
    """
    j = decisions.join(roots.select(F.col("type_key").alias("type"), "root"), "type", "left")
    major = F.coalesce("root", "type")
    divided = parents.select(F.col("parent").alias("__p"), F.lit(True).alias("__d")).distinct()
    j = j.withColumn("cell_type", major).join(divided, F.col("cell_type") == F.col("__p"), "left")
    subtype = F.when(F.col("type") != F.col("cell_type"), F.col("type")).when(F.col("__d"), "unresolved").otherwise("N/A")
    return j.select("cluster", "cell_type", subtype.alias("subtype"))


def quality_report(cells: DataFrame, passed: Column) -> DataFrame:
    """Share of cells that pass, whether the knowledge base is blind here, and how strict to be next; one row."""
    rate = F.count_if(passed) / F.greatest(F.count(F.lit(1)), F.lit(1))
    out = cells.agg(F.count(F.lit(1)).alias("n_cells"), rate.alias("pass_rate"))
    strict = F.when(F.col("pass_rate") < 0.1, "relaxed").when(F.col("pass_rate") < 0.3, "deep").otherwise("default")
    return out.withColumn("blind_spot", F.col("pass_rate") < 0.1).withColumn("strictness", strict)


def suggested_clusters(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Number of clusters to aim at: the median of the tissue and species, if known, else of the tissue.

    ``counts(tissue, species, n)``, ``wanted(tissue, species)``; the median is cut to a whole number.
    """
    median = lambda *by: counts.groupBy(*by).agg(F.floor(F.median("n")).alias("m"))
    own = median("tissue", "species").withColumnRenamed("m", "own")
    return wanted.join(own, ["tissue", "species"], "left").join(median("tissue").withColumnRenamed("m", "any"), "tissue", "left").select(
        "tissue", "species", F.coalesce("own", "any").alias("n_clusters")
    )


def transitions(scores: DataFrame, parents: DataFrame, kb: DataFrame, forbidden: DataFrame, near: float = 0.15, least: float = LEAST_SCORE) -> DataFrame:
    """Clusters between two types: the best two are near, high enough, of one parent, not forbidden and share markers.

    ``parents(type, parent)``, ``kb(type, gene)``, ``forbidden(a, b)`` in any order. Markers that the parent has do not count.
    """
    order = Window.partitionBy("cluster").orderBy(F.desc("score"), "type")
    k = scores.withColumn("k", F.row_number().over(order)).where("k <= 2")
    two = k.groupBy("cluster").agg(*[F.max(F.when(F.col("k") == i, F.col(c))).alias(f"{c}{i}") for i in (1, 2) for c in ("type", "score")])
    two = two.where((F.col("score1") - F.col("score2") < near) & (F.col("score1") >= least))
    up = lambda i: parents.select(F.col("type").alias(f"type{i}"), F.col("parent").alias(f"parent{i}"))
    two = two.join(up(1), "type1").join(up(2), "type2").where("parent1 = parent2 and parent1 <> ''")
    pair = lambda a, b: F.concat_ws("\x1f", F.least(a, b), F.greatest(a, b)).alias("pair")
    two = two.withColumn("pair", pair("type1", "type2")).join(forbidden.select(pair("a", "b")).distinct(), "pair", "left_anti")
    genes = kb.select("type", "gene").distinct()
    of = lambda i: genes.select(F.col("type").alias(f"type{i}"), "gene")
    shared = two.join(of(1), "type1").join(of(2), ["type2", "gene"]).join(genes.select(F.col("type").alias("parent1"), "gene"), ["parent1", "gene"], "left_anti")
    return shared.select("cluster", "type1", "type2").distinct()


def kb_violations(kb: DataFrame, negatives: DataFrame, rules: DataFrame, least_markers: int = 3, least_sources: int = 2) -> DataFrame:
    """``rule, item``: types with few markers or sources, genes on both sides, rules whose action is no type or that contradict.

    ``kb(type, gene, source)``, ``negatives(type, gene)``, ``rules(rule_id, action, gene, present BOOLEAN)``.
    """
    say = lambda df, rule, item: df.select(F.lit(rule).alias("rule"), item.cast("string").alias("item")).distinct()
    per = kb.groupBy("type").agg(F.countDistinct("gene").alias("g"), F.countDistinct("source").alias("s"))
    both = kb.join(negatives, ["type", "gene"], "left_semi")
    present, absent = rules.where("present").select("rule_id", "gene"), rules.where("not present").select("rule_id", "gene")
    return reduce(DataFrame.unionByName, [
        say(per.where(F.col("g") < least_markers), "few markers", F.col("type")), say(per.where(F.col("s") < least_sources), "few sources", F.col("type")),
        say(both, "positive and negative", F.concat_ws("|", "type", "gene")),
        say(rules.join(kb.select(F.col("type").alias("action")).distinct(), "action", "left_anti"), "unknown action", F.col("rule_id")),
        say(present.join(absent, ["rule_id", "gene"], "left_semi"), "contradiction", F.col("rule_id")),
    ])


def second_pass(decisions: DataFrame, potency: bool = False) -> DataFrame:
    """Clusters to look at again: of low or no confidence and not ambiguous; ambiguous and transitional ones only if ``potency``."""
    unclear = F.col("method").isin("ambiguous", "transition_state")
    weak = F.col("confidence").isin("low", "unknown") & (F.col("method") != "ambiguous")
    return decisions.where(weak | (F.lit(potency) & unclear))


def retried(first: DataFrame, second: DataFrame, clusters: DataFrame) -> DataFrame:
    """``cluster, hits, retried``: hits of a second scoring, without regard to letter case, where the first found none.

    Only with at least 3 clusters, and only where it finds something. ``first`` and ``second`` are ``cluster, hits``.
    """
    n = clusters.agg(F.count_distinct("cluster").alias("n"))
    per = lambda df, name: df.groupBy("cluster").agg(F.sum("hits").alias(name))
    j = clusters.select("cluster").distinct().join(per(first, "a"), "cluster", "left").join(per(second, "b"), "cluster", "left").crossJoin(F.broadcast(n))
    a, b = F.coalesce("a", F.lit(0).cast("bigint")), F.coalesce("b", F.lit(0).cast("bigint"))
    again = (a == 0) & (b > 0) & (F.col("n") >= 3)
    return j.select("cluster", F.when(again, b).otherwise(a).alias("hits"), again.alias("retried"))
