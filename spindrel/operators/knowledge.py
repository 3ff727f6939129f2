"""Marker knowledge base: merging sources, consensus, conflicts, hierarchy, scoring and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.runtime import checkpoint

# Weights, thresholds and orders of the decision tables.
LEVELS = {"gold": 5, "high": 3, "medium": 2}
SOURCES = ("marker", "expert", "ai", "celltypist")


def merge_markers(markers: DataFrame) -> DataFrame:
    """Distinct sources of each ``type, tier, gene``."""
    return markers.groupBy("type", "tier", "gene").agg(
        F.sort_array(F.collect_set("source")).alias("sources"), F.countDistinct("source").alias("n_sources")
    )


def consensus(n: Column) -> Column:
    """Level of support of a number of sources."""
    out = F.lit("low")
    for level, least in reversed(LEVELS.items()):
        out = F.when(n >= least, level).otherwise(out)
    return out


def effective_votes(markers: DataFrame, roots: DataFrame, injected: DataFrame, modalities: DataFrame) -> DataFrame:
    """Votes of independent sources for each ``type, gene``.

    A source counts 1, nothing where its entry was injected (``type, source``), and half if all its roots
    (``source, root``) are roots of other sources of the same marker. One half more if some root is shared by
    voting sources of two modalities (``source, modality``).
    """
    base = markers.select("type", "gene", "source").distinct()
    flagged = base.join(injected.select("type", "source", F.lit(0.0).alias("__zero")).distinct(), ["type", "source"], "left")
    rooted = flagged.join(roots.distinct(), "source", "left")
    same = ["type", "gene", "root"]
    holders = rooted.where("root is not null").groupBy(*same).agg(F.countDistinct("source").alias("__holders"))
    covered = rooted.join(holders, same, "left").groupBy("type", "gene", "source").agg(
        F.max("__zero").alias("zero"), F.max("root").alias("any_root"), F.min("__holders").alias("least")
    )
    vote = F.when(F.col("zero").isNotNull(), 0.0).when(F.col("any_root").isNull(), 1.0).when(F.col("least") > 1, 0.5).otherwise(1.0)
    voting = rooted.where("root is not null and __zero is null").join(modalities.distinct(), "source", "left")
    bonus = voting.groupBy(*same).agg(F.countDistinct("source").alias("s"), F.countDistinct("modality").alias("m")).where("s >= 2 and m >= 2")
    bonus = bonus.groupBy("type", "gene").agg(F.lit(0.5).alias("bonus"))
    votes = covered.groupBy("type", "gene").agg(F.sum(vote).alias("votes"))
    return votes.join(bonus, ["type", "gene"], "left").select("type", "gene", (F.col("votes") + F.coalesce("bonus", F.lit(0.0))).alias("votes"))


def conflicts(merged: DataFrame) -> DataFrame:
    """Genes that are markers of two types, in order of their names, and the side that wins with 3 sources and more."""
    per = merged.groupBy("type", "gene").agg(F.max("n_sources").alias("n"))
    a, b = per.select("gene", F.col("type").alias("type_a"), F.col("n").alias("n_a")), per.select("gene", F.col("type").alias("type_b"), F.col("n").alias("n_b"))
    winner = F.when((F.col("n_a") >= 3) & (F.col("n_a") > F.col("n_b")), F.col("type_a")).when((F.col("n_b") >= 3) & (F.col("n_b") > F.col("n_a")), F.col("type_b"))
    return a.join(b, "gene").where("type_a < type_b").withColumn("winner", winner)


def private_markers(merged: DataFrame, most: int = 2) -> DataFrame:
    """Genes that at most ``most`` types use."""
    return merged.groupBy("gene").agg(F.countDistinct("type").alias("n_types"), F.min("type").alias("first_type")).where(F.col("n_types") <= most)


def forced_genes(merged: DataFrame, least: int, denied: list[str]) -> DataFrame:
    """Genes with a level of at least ``least`` sources, without the denied ones."""
    return merged.where((F.col("n_sources") >= least) & ~F.col("gene").isin(denied)).select("gene").distinct()


def best_rules(rules: DataFrame, key: list[str]) -> DataFrame:
    """One rule of each action and condition: the one with the lowest priority number, then the lowest id."""
    order = Window.partitionBy(*key).orderBy("priority", "rule_id")
    return rules.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")


def fired_rules(markers: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule of highest priority that fires for each cluster.

    ``markers(cluster, gene, logfc)``; ``rules(rule_id, priority, present MAP<gene, least logfc>, absent ARRAY, action)``.
    A rule fires if every present gene is a marker with at least its fold change and no absent gene is one.
    """
    need = rules.select("rule_id", F.size("present").alias("__need"), F.explode("present").alias("gene", "least"))
    held = markers.groupBy("cluster", "gene").agg(F.max("logfc").alias("logfc")).join(need, "gene").where("logfc >= least")
    full = held.groupBy("cluster", "rule_id").agg(F.count(F.lit(1)).alias("n"), F.max("__need").alias("need")).where("n = need")
    banned = rules.select("rule_id", F.explode("absent").alias("gene"))
    blocked = markers.join(banned, "gene").select("cluster", "rule_id").distinct()
    order = Window.partitionBy("cluster").orderBy(F.desc("priority"), "rule_id")
    out = full.join(blocked, ["cluster", "rule_id"], "left_anti").join(rules.select("rule_id", "priority", "action"), "rule_id")
    return out.withColumn("__k", F.row_number().over(order)).where("__k = 1").select("cluster", "rule_id", "priority", "action")


def score_types(top: DataFrame, kb: DataFrame) -> DataFrame:
    """Set overlap of each cluster's genes with each type's markers; pairs without a common gene have none.

    ``top(cluster, gene)``, ``kb(type, gene)``, both distinct. ``cosine`` is that of the two sets.
    """
    sizes = top.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_top"))
    types = kb.groupBy("type").agg(F.count(F.lit(1)).alias("n_type"))
    hits = top.join(kb, "gene").groupBy("cluster", "type").agg(F.count(F.lit(1)).alias("hits"))
    return hits.join(sizes, "cluster").join(types, "type").withColumn("cosine", F.col("hits") / F.sqrt(F.col("n_top") * F.col("n_type")))


def confidence(n_markers: Column) -> Column:
    """Multiplier by the number of markers a type has."""
    return F.when(n_markers > 5, 1.0).when(n_markers >= 3, 0.8).otherwise(0.5)


def evidence_class(n_top: Column, window: Column, level: Column) -> Column:
    """Kind of evidence from hits among the first 20, the width of the window and the best level."""
    return (
        F.when((n_top < 2) & (window > 20), "window_padding").when(n_top == 0, "zero_evidence").when(n_top == 1, "single_marker")
        .when(level.isin("gold", "high"), "multi_marker").when(level.isin("medium", "low"), "weak_multi").otherwise("multi_marker")
    )


def phylogenetic_weight(source: Column, target: Column, source_order: Column, target_order: Column, n_classes: Column) -> Column:
    """Weight of evidence from another class of animals; null or empty targets weigh nothing down."""
    empty = lambda c: c.isNull() | (F.trim(c) == "")
    same = F.lower(F.trim(source)) == F.lower(F.trim(target))
    order = F.when(empty(target_order) | empty(source_order) | (F.lower(F.trim(source_order)) == F.lower(F.trim(target_order))), 1.0).otherwise(0.8)
    far = F.when(n_classes >= 3, 0.9).when(n_classes >= 2, 0.8).otherwise(0.6)
    return F.when(empty(target), 1.0).when(empty(source), 0.8).when(same, order).otherwise(far)


def potency(scores: DataFrame, ratio: float = 2.0, gap: float = 0.1, least: float = 0.6, epsilon: float = 1e-6) -> DataFrame:
    """Progenitor against terminal evidence of each cluster; ``scores(cluster, type, score, pole)``.

    The best progenitor type is the one with the highest score, then the last name.
    """
    positive = scores.where("score > 0")
    of = lambda pole: F.coalesce(F.max(F.when(F.col("pole") == pole, F.col("score"))), F.lit(0.0))
    best = F.max(F.when(F.col("pole") == "progenitor", F.struct("score", "type")))["type"]
    out = scores.select("cluster").distinct().join(
        positive.groupBy("cluster").agg(of("progenitor").alias("max_prog"), of("terminal").alias("max_term"), best.alias("best")), "cluster", "left"
    ).na.fill(0.0, ["max_prog", "max_term"])
    return out.withColumns({
        "ratio": F.col("max_prog") / F.greatest("max_term", F.lit(epsilon)), "gap": F.col("max_prog") - F.col("max_term"),
    }).withColumns({
        "passes_ratio": F.col("ratio") >= ratio, "passes_gap": F.col("gap") >= gap,
        "passes_abs": (F.col("max_prog") >= least) & (F.col("max_prog") > F.col("max_term")),
    })


def arbitrate(votes: DataFrame, key: str, least: int = 3) -> DataFrame:
    """Decision of four sources, one column each (``SOURCES``); null or empty votes are none.

    Fewer than ``least`` votes decide nothing. One label: it wins. Two: unknown. Three and more: a transition
    between the two with most votes, ties in the order of the sources.
    """
    long = votes.select(key, F.posexplode(F.array(*[F.col(s) for s in SOURCES])).alias("at", "label")).where("label is not null and label <> ''")
    per = long.groupBy(key, "label").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "first", "label")))
    ranked = per.groupBy(key).agg(F.sum("n").alias("n_votes"), F.count(F.lit(1)).alias("n_labels"), order.alias("r"))
    a, b = F.col("r")[0]["label"], F.get("r", F.lit(1))["label"]
    enough = F.col("n_votes") >= least
    label = F.when(F.col("n_labels") >= 3, F.concat(F.lit("transitional: "), a, F.lit("/"), b)).when(F.col("n_labels") == 2, "Unknown").otherwise(a)
    reason = F.when(F.col("n_labels") >= 3, "divergent").when(F.col("n_labels") == 2, "two_way").otherwise("consensus")
    return votes.select(key).join(ranked, key, "left").select(
        key, F.coalesce("n_votes", F.lit(0).cast("bigint")).alias("n_votes"), F.coalesce("n_labels", F.lit(0).cast("bigint")).alias("n_labels"),
        F.when(enough, label).alias("label"), F.when(enough, reason).alias("reason"),
    )


def tier(score: Column) -> Column:
    """Confidence of a fused label."""
    return F.when(score >= 0.7, "high").when(score >= 0.5, "medium").when(score >= 0.25, "low").otherwise("unknown")


def fuse(scores: DataFrame, rules: DataFrame, low_quality: DataFrame, near: float = 0.15, least: float = 0.25) -> DataFrame:
    """One decision for each cluster from scores, rules and quality, by one ordered list of cases.

    Low-quality clusters first, then a fired rule, then nothing scored, then two types within ``near`` of each
    other at the top (a transition), then the best type with the tier of its score.
    """
    order = Window.partitionBy("cluster").orderBy(F.desc("score"), "type")
    two = scores.withColumn("k", F.row_number().over(order)).where("k <= 2").groupBy("cluster").agg(
        F.max(F.when(F.col("k") == 1, F.col("type"))).alias("t1"), F.max(F.when(F.col("k") == 1, F.col("score"))).alias("s1"),
        F.max(F.when(F.col("k") == 2, F.col("type"))).alias("t2"), F.max(F.when(F.col("k") == 2, F.col("score"))).alias("s2"),
    )
    keys = scores.select("cluster").union(rules.select("cluster")).union(low_quality.select("cluster")).distinct()
    j = keys.join(two, "cluster", "left").join(rules.select("cluster", "action"), "cluster", "left")
    j = j.join(low_quality.select("cluster", F.lit(True).alias("low")), "cluster", "left")
    cases = [
        (F.coalesce("low", F.lit(False)), F.lit("Low_quality"), F.lit("low"), "quality"),
        (F.col("action").isNotNull(), F.col("action"), F.lit("high"), "rule"),
        (F.col("s1").isNull() | (F.col("s1") < least), F.lit("Unknown"), F.lit("unknown"), "none"),
        ((F.col("s1") - F.col("s2")) <= near, F.concat_ws("/", F.least("t1", "t2"), F.greatest("t1", "t2")), F.lit("transition"), "transition"),
        (F.lit(True), F.col("t1"), tier(F.col("s1")), "score"),
    ]
    pick = lambda k: F.coalesce(*[F.when(F.coalesce(c[0], F.lit(False)), c[k] if k < 3 else F.lit(c[k])) for c in cases])
    return j.select("cluster", pick(1).alias("label"), pick(2).alias("confidence"), pick(3).alias("method"))


def ancestors(types: DataFrame) -> DataFrame:
    """The root of each entry of a hierarchy ``type_key, parent`` and its depth; a parent that is missing ends the walk.

    Each round, written to the checkpoint folder, doubles the steps walked, until all stand at a root. ``type_key`` is
    unique. A walk of more steps than there are entries goes in a circle, and it fails.
    """
    known = types.select(F.col("type_key").alias("parent"), F.lit(True).alias("__hit")).distinct()
    here = checkpoint(types.join(known, "parent", "left").select(
        "type_key", F.when(F.col("__hit"), F.col("parent")).otherwise(F.col("type_key")).alias("root"), F.when(F.col("__hit"), 1).otherwise(0).alias("depth"),
    ))
    entries = here.count()
    while True:
        step = here.where("depth > 0").select(F.col("type_key").alias("root"), F.col("root").alias("__next"), F.col("depth").alias("__more"))
        if here.join(step, "root", "left_semi").isEmpty():
            return here
        further = F.col("depth") + F.coalesce("__more", F.lit(0))
        here = checkpoint(here.join(step, "root", "left").select("type_key", F.coalesce("__next", "root").alias("root"), further.alias("depth")))
        if not here.where(F.col("depth") > entries).isEmpty():
            raise ValueError("the hierarchy has a cycle")
