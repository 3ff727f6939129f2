"""Genomic intervals: nearest feature, overlaps, chromosome sizes. Work is cut by chromosome and bin, so no pair is tried twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest(points: DataFrame, features: DataFrame, most: int, bin_width: int | None = None) -> DataFrame:
    """The nearest feature of each point on its chromosome within ``most``; null if there is none.

    ``points(id, chrom, pos)``, ``features(chrom, site, name)``. Of equal distances the feature at or after the point
    wins; of features at one site the first name. Both sides are sorted together within ``(chrom, bin)``; as bins are at
    least as wide as ``most``, only the neighbouring bins' last and first feature can be nearer than those inside.
    """
    width = F.lit(max(bin_width or most, most, 1))
    sites = features.groupBy("chrom", "site").agg(F.min("name").alias("name")).withColumn("bin", F.floor(F.col("site") / width))
    edge = sites.groupBy("chrom", "bin").agg(F.min(F.struct("site", "name")).alias("lo"), F.max(F.struct("site", "name")).alias("hi"))
    after = edge.select("chrom", (F.col("bin") - 1).alias("bin"), F.col("lo").alias("f"))
    before = edge.select("chrom", (F.col("bin") + 1).alias("bin"), F.col("hi").alias("f"))
    inside = sites.select("chrom", "bin", F.struct("site", "name").alias("f"))
    side = inside.unionByName(after).unionByName(before).select("chrom", "bin", F.col("f.site").alias("pos"), F.col("f").alias("f"), F.lit(None).cast("string").alias("id"))
    probe = points.select("chrom", F.floor(F.col("pos") / width).alias("bin"), F.col("pos").cast("bigint").alias("pos"), F.lit(None).cast("struct<site:bigint,name:string>").alias("f"), F.col("id").cast("string").alias("id"))
    both = side.withColumn("f", F.col("f").cast("struct<site:bigint,name:string>")).withColumn("pos", F.col("pos").cast("bigint")).unionByName(probe)
    order = Window.partitionBy("chrom", "bin").orderBy("pos", F.col("id").isNotNull())
    back = F.last("f", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    order_ahead = Window.partitionBy("chrom", "bin").orderBy("pos", F.col("id").isNull())
    ahead = F.first("f", ignorenulls=True).over(order_ahead.rowsBetween(0, Window.unboundedFollowing))
    w = both.withColumn("b", back).withColumn("a", ahead).where("id is not null")
    da, db = F.col("a.site") - F.col("pos"), F.col("pos") - F.col("b.site")
    use_a = da.isNotNull() & (db.isNull() | (da <= db))
    pick = F.when(use_a, F.col("a")).otherwise(F.col("b"))
    distance = F.when(use_a, da).otherwise(db)
    near = distance <= most
    return w.select("id", "chrom", "pos", F.when(near, pick["name"]).alias("name"), F.when(near, distance).alias("distance"))


def overlaps(a: DataFrame, b: DataFrame, bin_width: int) -> DataFrame:
    """Pairs of half-open intervals that overlap, by bins; each pair once.

    Both have ``id, chrom, start, end``. A pair is taken in the bin where the later of the two starts lies.
    """
    def binned(df: DataFrame, tag: str) -> DataFrame:
        last = F.floor((F.greatest("end", F.col("start") + 1) - 1) / bin_width)
        return df.select(
            F.col("id").alias(f"id_{tag}"), "chrom", F.col("start").alias(f"start_{tag}"), F.col("end").alias(f"end_{tag}"),
            F.explode(F.sequence(F.floor(F.col("start") / bin_width), last)).alias("bin"),
        )

    both = binned(a, "a").join(binned(b, "b"), ["chrom", "bin"])
    first = F.floor(F.greatest("start_a", "start_b") / bin_width) == F.col("bin")
    return both.where(first & (F.col("start_a") < F.col("end_b")) & (F.col("start_b") < F.col("end_a"))).drop("bin")


def chrom_sizes(fragments: DataFrame, margin: int = 10_000) -> DataFrame:
    return fragments.groupBy("chrom").agg((F.max("end") + margin).alias("size"))


def standard_chromosomes(chrom: Column, autosomes: int = 22) -> Column:
    """Autosomes, X and Y."""
    return chrom.isin([f"chr{c}" for c in [*range(1, autosomes + 1), "X", "Y"]])
