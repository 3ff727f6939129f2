"""Top N items within every group, by histogram threshold and exact ranking.

Each group's scores are counted in bins, with the least score of each bin. Counting down from the
highest bin until N items are reached gives a bin whose least score at least N items reach, so that no
item below it can be among the first N: they are dropped before anything is ranked. The survivors are
ranked exactly by score and tie keys. The thresholds, one for each group, are broadcast if they are few
enough, so that only survivors are shuffled; else rows and thresholds meet by a shuffle. Survivors can still be many if a group is huge and its scores are
equal; such groups are cut into parts by a hash of the item, each part keeps its own first N, and only
these meet in the group's final ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.runtime import checkpoint, task_count

PART_ROWS = 100_000
BROADCAST_GROUPS = 100_000
_BINS_PER_UNIT = 64
#: Names of columns in between; no input column may begin with this prefix.
LIMIT, BIN, N, LEAST, ABOVE, PARTS, PART, RANK = (f"__spindrel_{x}" for x in "limit bin n least above parts part rank".split())


def top_per_group(
    items: DataFrame,
    group: list[str],
    score: str,
    ties: list[Column],
    limit: Column,
    part_key: Column,
    part_rows: int = PART_ROWS,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """The first ``limit`` rows of each group by ``score`` descending and then ``ties``, with their ``rank``.

    ``limit`` is a column that is constant within a group; null or below 1 keeps nothing. Rows with a null
    or NaN score, or a null group column, do not rank. ``part_key`` spreads a group's rows and should
    differ between them. All columns of ``items`` come back; one named ``rank`` is replaced. The order is total, and the result the same in every run, if score and ties
    together tell rows apart. An empty table gives an empty result.
    """
    alive = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    for g in group:
        alive &= F.col(g).isNotNull()
    rows = items.where(alive).withColumn(LIMIT, limit.cast("bigint")).where(F.col(LIMIT) > 0)

    # Any bin will do, as what is compared in the end is the least score within it.
    x = F.col(score).cast("double")
    bin_ = F.floor(F.signum(x) * F.ln(1 + F.least(F.abs(x), F.lit(1e300))) * _BINS_PER_UNIT)
    histogram = checkpoint(
        rows.groupBy(*group, bin_.alias(BIN)).agg(F.count(F.lit(1)).alias(N), F.min(x).alias(LEAST), F.max(LIMIT).alias(LIMIT))
    )
    down = Window.partitionBy(*group).orderBy(F.desc(BIN))
    counted = histogram.withColumn(ABOVE, F.sum(N).over(down) - F.col(N))
    thresholds = counted.where(F.col(ABOVE) < F.col(LIMIT)).groupBy(*group).agg(F.min(LEAST).alias(LEAST))

    total, n_groups = histogram.groupBy(*group).agg(F.sum(N).alias(N)).agg(F.sum(N), F.count(F.lit(1))).first()
    total = total or 0
    most = max(part_rows, total // (task_count(items.sparkSession) * 16))
    large = (
        histogram.groupBy(*group).agg(F.sum(N).alias(N)).where(F.col(N) > most)
        .select(*group, F.ceil(F.col(N) / most).cast("int").alias(PARTS))
    )  # fewer than 16 groups for each task, as their sizes add up to the total at most
    parts = F.coalesce(PARTS, F.lit(1))
    rows = rows.join(F.broadcast(large), group, "left").withColumn(PART, F.pmod(F.xxhash64(part_key, F.lit(31)), parts).cast("int"))
    if n_groups <= broadcast_groups:
        kept = rows.drop(PARTS).join(F.broadcast(thresholds), group)
    else:
        thresholds = thresholds.join(F.broadcast(large), group, "left").select(*group, LEAST, F.explode(F.sequence(F.lit(0), parts - 1)).alias(PART))
        kept = rows.drop(PARTS).join(thresholds, [*group, PART])
    kept = kept.where(x >= F.col(LEAST)).drop(LEAST)
    order = [F.desc(score), *ties]
    in_part = F.row_number().over(Window.partitionBy(*group, PART).orderBy(*order))
    in_group = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    first = kept.withColumn(RANK, in_part).where(F.col(RANK) <= F.col(LIMIT)).drop(RANK)
    ranked = first.withColumn(RANK, in_group).where(F.col(RANK) <= F.col(LIMIT))
    return ranked.select(*[c for c in items.columns if c != "rank"], F.col(RANK).alias("rank"))


def latest(df: DataFrame, key: list[str], at: str, tie: str, keep: list[str]) -> DataFrame:
    """The row of each key with the latest ``at`` (nulls are earliest), then the greatest ``tie``."""
    newest = F.max(F.struct(at, tie, *[c for c in keep if c not in (at, tie)])).alias("r")
    return df.groupBy(*key).agg(newest).select(*key, *[F.col("r")[c].alias(c) for c in keep])
