"""Across data sets: gene-set vectors, their graph and its parts; agreement of labels; registry checks."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spindrel.runtime import checkpoint, task_count

#: Most genes of the vectors of one block.
BLOCK = 1_000_000


def top_sets(rows: DataFrame, n: int = 15, least: int = 3) -> DataFrame:
    """``cluster, gene``: the ``n`` best genes of each cluster of ``rows(cluster, gene, score)``, of clusters with at least ``least`` of them.

    A gene counts once, with its best score; equal scores go by name.
    """
    best = rows.groupBy("cluster", "gene").agg(F.max("score").alias("score"))
    own = Window.partitionBy("cluster")
    top = best.withColumn("k", F.row_number().over(own.orderBy(F.desc("score"), "gene"))).where(F.col("k") <= n)
    return top.withColumn("m", F.count(F.lit(1)).over(own)).where(F.col("m") >= least).select("cluster", "gene")


def idf_vectors(sets: DataFrame) -> DataFrame:
    """Unit vectors of ``cluster, gene`` with weights ``ln((n + 1) / (df + 1))``, n clusters and df of them with the gene."""
    n = sets.select("cluster").distinct().count()
    df = sets.groupBy("gene").agg(F.countDistinct("cluster").alias("df"))
    idf = sets.select("cluster", "gene").distinct().join(df, "gene").withColumn("w", F.ln((F.lit(n) + 1) / (F.col("df") + 1)))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("cluster")))
    return idf.select("cluster", "gene", F.when(norm > 0, F.col("w") / F.when(norm > 0, norm)).otherwise(0.0).alias("w"))


def cosine_edges(vectors: DataFrame, least: float) -> DataFrame:
    """Pairs ``a < b`` with a cosine of at least ``least`` (above 0).

    Clusters are dealt to blocks by hash. Blocks are written to the checkpoint folder, from where every task reads two and
    sums the common genes of their pairs, a million at a time: neither vectors in many copies nor pairs are shuffled.
    """
    kind = vectors.schema["cluster"].dataType
    entries = F.sort_array(F.collect_list(F.struct("gene", "w")))
    packed = vectors.where("w > 0 and cluster is not null and gene is not null").groupBy("cluster").agg(entries.alias("e"))
    packed = checkpoint(packed.select("cluster", F.col("e.gene").alias("genes"), F.col("e.w").alias("ws")))
    size = packed.agg(F.sum(F.size("genes"))).first()[0] or 0
    # More pairs of blocks than shuffle tasks, unless the blocks become small by it.
    blocks = max(1, math.ceil(size / BLOCK), min(math.ceil(math.sqrt(2 * task_count(vectors.sparkSession))), math.ceil(size / (BLOCK / 100))))
    dealt = packed.groupBy(F.pmod(F.xxhash64("cluster"), F.lit(blocks)).cast("int").alias("own")).agg(F.collect_list(F.struct("cluster", "genes", "ws")).alias("block"))
    dealt = checkpoint(dealt.repartitionById(blocks, F.col("own")))
    low, high = (dealt.select(F.col("own").alias(f"own_{x}"), F.col("block").alias(x)) for x in ("low", "high"))
    met = low.join(high.hint("shuffle_replicate_nl"), F.col("own_low") <= F.col("own_high"))
    schema = StructType([StructField("a", kind), StructField("b", kind), StructField("cosine", DoubleType())])
    found = met.mapInArrow(lambda batches: (e for x in batches for k in range(x.num_rows) for e in _block_edges(x.slice(k, 1), least)), schema)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine")


def _block_edges(pair: pa.RecordBatch, least: float, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Edges between the vectors of two blocks, or among those of a block that meets itself; about ``most`` products are held at once."""
    apart = pair["own_low"][0].as_py() != pair["own_high"][0].as_py()
    parts = [pair[x].flatten().flatten() for x in ("low", "high")[: 1 + apart]]
    names, genes, ws = (pa.concat_arrays(x) for x in zip(*parts, strict=True))
    n, side = len(names), np.repeat([-1, 1] if apart else [0], [len(x[0]) for x in parts])
    gene = genes.flatten().dictionary_encode().indices.to_numpy().astype("int64")
    w, row = ws.flatten().to_numpy(), np.repeat(np.arange(n), pc.list_value_length(genes).to_numpy())
    held = np.flatnonzero(side[row] >= 0)  # by gene, and by row within it
    held = held[np.argsort(gene[held], kind="stable")]
    meets = np.bincount(gene[held], minlength=gene.max() + 1)
    begin = np.cumsum(meets) - meets
    asks = np.flatnonzero(side[row] <= 0)
    times = meets[gene[asks]]
    total = np.cumsum(times)
    last = np.flatnonzero(np.diff(row[asks], append=-1)) + 1  # the rows' ends in asks: a row is not divided
    sums = total[last - 1]
    at = done = 0
    while at < len(asks):
        to = last[max(np.searchsorted(sums, done + most, side="right") - 1, np.searchsorted(last, at, side="right"))]
        k = times[at:to]
        first = np.repeat(asks[at:to], k)
        second = held[np.arange(len(first)) + np.repeat(begin[gene[asks[at:to]]] - (np.cumsum(k) - k), k)]
        at, done = to, total[to - 1]
        key = row[first] * n + row[second]
        kept = np.flatnonzero((row[first] < row[second]) | (side[row[first]] < 0))
        kept = kept[np.argsort(key[kept], kind="stable")]
        if not len(kept):
            continue
        key = key[kept]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        cosine = np.add.reduceat(w[first[kept]] * w[second[kept]], new)
        key, cosine = key[new][cosine >= least], cosine[cosine >= least]
        yield pa.RecordBatch.from_arrays([names.take(pa.array(key // n)), names.take(pa.array(key % n)), pa.array(cosine)], ["a", "b", "cosine"])


def cosine_pairs(vectors: DataFrame, least: float) -> DataFrame:
    """The same for short vectors, of which nearly every gene would start a pair: their common genes are summed at once."""
    v = vectors.where("w > 0")
    a, b = (v.select(F.col("cluster").alias(c), "gene", F.col("w").alias(f"w{c}")) for c in "ab")
    dots = a.join(b, "gene").where("a < b").groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine"))
    return dots.where(F.col("cosine") >= least)


def _stars(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges that connect the same nodes as those of one task, each node to the root of its part: fewer than nodes."""
    up: dict = {}

    def root(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for own in batches:
        for u, v in zip(own["u"].tolist(), own["v"].tolist(), strict=True):
            u, v = root(u), root(v)
            up[max(u, v)] = min(u, v)
    nodes = list(up)
    for k in range(0, len(nodes), 10_000):
        part = nodes[k : k + 10_000]
        yield pd.DataFrame({"u": [root(x) for x in part], "v": part})


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``node, component`` (its smallest node): large-star and small-star rounds until nothing changes.

    Of its edges each task first keeps what connects the same nodes. Each round is written to the checkpoint folder.
    Stars halve paths, so rounds grow with the log of the longest.
    Labels that still change after ``most_rounds`` are not returned; it fails.
    """
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    ends = ends.mapInPandas(_stars, ends.schema).where("u <> v")
    e = checkpoint(ends.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
    before = mark(e)  # distinct edges are the same if their number and two sums of hashes are
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        low = large.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("m"))
        small = large.select(F.col("v").alias("x"), F.col("u").alias("y")).join(low, "x")
        nxt = checkpoint(
            small.select(F.col("m").alias("u"), F.col("y").alias("v")).unionByName(small.select(F.col("m").alias("u"), F.col("x").alias("v")))
            .where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        )
        now = mark(nxt)
        e, before, changed = nxt, now, now != before
        if not changed:
            break
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    root = e.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
    return nodes.select("node").distinct().join(root, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def best_overlap(sets: DataFrame, kb: DataFrame, least: int = 3) -> DataFrame:
    """The type with most common genes of each cluster, if at least ``least``; ties by name."""
    hits = sets.join(kb, "gene").groupBy("cluster", "type").agg(F.countDistinct("gene").alias("n")).where(F.col("n") >= least)
    order = Window.partitionBy("cluster").orderBy(F.desc("n"), "type")
    return hits.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")


def label_agreement(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Commonest and second label of each cluster and their shares."""
    n = df.where(F.col(label).isNotNull()).groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(cluster).orderBy(F.desc("n"), label)
    r = n.withColumn("k", F.row_number().over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(cluster)))
    of = lambda k, v: F.max(F.when(F.col("k") == k, v))
    share = F.col("n") / F.col("all")
    return r.groupBy(cluster).agg(of(1, F.col(label)).alias("top"), of(1, share).alias("top_share"), of(2, F.col(label)).alias("second"), of(2, share).alias("second_share"))


def confusion(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of all pairs of labels with margins (null stands for all)."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).cube(a, b).agg(F.count(F.lit(1)).alias("n"))


def composition(df: DataFrame, stage: str, label: str) -> DataFrame:
    """Cells of each label in each stage and their share of the stage."""
    n = df.groupBy(stage, label).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(stage)))


def missing_links(links: DataFrame, key: str, targets: DataFrame, target_key: str, finding: str) -> DataFrame:
    """A finding for each distinct key of ``links`` that ``targets`` lacks."""
    lost = links.where(F.col(key).isNotNull()).join(targets.select(F.col(target_key).alias(key)), key, "left_anti")
    return lost.select(F.lit(finding).alias("finding"), F.col(key).cast("string").alias("item")).distinct()


def search(df: DataFrame, columns: list[str], words: str) -> DataFrame:
    """Rows that hold the words in one of the columns, whatever the letter case."""
    hit: Column = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(words.lower())), F.lit(False))
    return df.where(hit)
