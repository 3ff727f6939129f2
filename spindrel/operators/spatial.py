"""Spots in the plane: neighbour graphs, autocorrelation and contacts of labels."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrel.runtime import checkpoint


def _near(points: DataFrame, radius: float, only: DataFrame | None = None) -> DataFrame:
    """Ordered pairs within ``radius``, through a grid of squares of that width and the eight around each; from ``only(src)`` if given."""
    cell = points.withColumn("gx", F.floor(F.col("px") / radius)).withColumn("gy", F.floor(F.col("py") / radius))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    from_ = cell if only is None else cell.join(only.select(F.col("src").alias("id")), "id", "left_semi")
    a = from_.select(F.col("id").alias("src"), F.col("px").alias("ax"), F.col("py").alias("ay"), "gx", "gy", F.explode(around).alias("o"))
    a = a.select("src", "ax", "ay", (F.col("gx") + F.col("o.i")).alias("gx"), (F.col("gy") + F.col("o.j")).alias("gy"))
    b = cell.select(F.col("id").alias("dst"), F.col("px").alias("bx"), F.col("py").alias("by"), "gx", "gy")
    d = F.sqrt(F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by"), 2))
    return a.join(b, ["gx", "gy"]).where("src <> dst").withColumn("distance", d).where(F.col("distance") <= radius).select("src", "dst", "distance")


def radius_graph(points: DataFrame, radius: float) -> DataFrame:
    """Edges between spots ``id, px, py`` at most ``radius`` apart, both ways."""
    return _near(points, radius)


def nearest_graph(points: DataFrame, k: int, radius: float | None = None) -> DataFrame:
    """The ``k`` nearest spots of each, exact: the search radius doubles for spots that have not found enough.

    The first radius holds about three times ``k`` spots at the mean density unless it is given. Spots that fewer
    than ``k`` others share the plane with get all of them. What each round finds goes to the checkpoint folder.
    """
    box = points.agg(F.count(F.lit(1)), F.max("px") - F.min("px"), F.max("py") - F.min("py")).first()
    n, width, height = box[0], box[1] or 0.0, box[2] or 0.0
    want, span = min(k, max(n - 1, 0)), math.hypot(width, height)
    radius = radius or math.sqrt(3 * k * width * height / (math.pi * max(n, 1))) or span or 1.0
    order = Window.partitionBy("src").orderBy("distance", "dst")
    out, todo = None, None
    while want:
        near = _near(points, radius, todo)
        ranked = checkpoint(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want))
        enough = ranked.where(F.col("rank") == want).select("src")
        done = ranked.join(enough, "src", "left_semi")
        out = done if out is None else out.unionByName(done)
        if radius >= span:
            break
        todo = checkpoint((points.select(F.col("id").alias("src")) if todo is None else todo).join(enough, "src", "left_anti"))
        if todo.isEmpty():
            break
        radius *= 2
    return out if out is not None else _near(points, radius).withColumn("rank", F.lit(1)).limit(0)


def morans_i(values: DataFrame, edges: DataFrame) -> DataFrame:
    """Moran's I of each feature; ``values(id, feature, v)`` has every spot, ``edges(src, dst, w)`` every ordered pair."""
    whole = Window.partitionBy("feature")
    z = values.withColumn("z", F.col("v") - F.avg("v").over(whole)).select("id", "feature", "z")
    a, b = z.select(F.col("id").alias("src"), "feature", F.col("z").alias("za")), z.select(F.col("id").alias("dst"), "feature", F.col("z").alias("zb"))
    cross = edges.join(a, "src").join(b, ["dst", "feature"]).groupBy("feature").agg(F.sum(F.col("w") * F.col("za") * F.col("zb")).alias("num"), F.sum("w").alias("ws"))
    own = z.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") * F.col("z")).alias("den"))
    return cross.join(own, "feature").select("feature", F.try_divide(F.col("n") / F.col("ws") * F.col("num"), "den").alias("moran"))


def label_contacts(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between each ordered pair of labels, and their ratio to what the labels' degrees alone would give."""
    a, b = labels.select(F.col("id").alias("src"), F.col("label").alias("a")), labels.select(F.col("id").alias("dst"), F.col("label").alias("b"))
    n = edges.join(a, "src").join(b, "dst").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    row, col, everything = Window.partitionBy("a"), Window.partitionBy("b"), Window.partitionBy()
    expected = F.sum("n").over(row) * F.sum("n").over(col) / F.sum("n").over(everything)
    return n.withColumn("ratio", F.col("n") / expected)


def co_occurrence(points: DataFrame, labels: DataFrame, radius: float, bins: int) -> DataFrame:
    """Pairs of labels by distance, in bins of equal width up to ``radius``."""
    pairs = _near(points, radius)
    a, b = labels.select(F.col("id").alias("src"), F.col("label").alias("a")), labels.select(F.col("id").alias("dst"), F.col("label").alias("b"))
    at = F.least(F.floor(F.col("distance") / (radius / bins)), F.lit(bins - 1)).cast("int")
    return pairs.join(a, "src").join(b, "dst").groupBy("a", "b", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
