"""A few keys holding most records: fragment-replicate by estimated load.

Keys are measured first. A key whose load is above ``total / (tasks * SPREAD)`` is heavy: it is cut
into shards in proportion to its load, to the next power of two. All other keys fall into a fixed number of
light buckets. Shards and buckets are packed onto tasks, largest first onto the least loaded one. The
fragmented side goes to the task of its shard; the matching side is replicated to the shards of its key and
nowhere else.

``tasks`` is the session's number of shuffle tasks and doesn't grow with the rows. What reaches the driver is
bounded by it: at most ``tasks * SPREAD`` heavy keys can exist, and there are ``tasks * BUCKETS`` light buckets.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.runtime import checkpoint, task_count

SPREAD = 4
BUCKETS = 16

#: Names of the columns that carry a row's fragment. The leading underscores keep them off user columns.
TASK, KEY, SHARD, CUT = "__task", "__key", "__shard", "__cut"


def pack(loads: dict, tasks: int) -> dict:
    """Largest-first packing of ``{item: load}`` onto ``tasks``; equal loads in order of the item."""
    heap = [(0, t) for t in range(tasks)]
    where = {}
    for item, load in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        used, t = heapq.heappop(heap)
        where[item] = t
        heapq.heappush(heap, (used + load, t))
    return where


def shards_of(load: int, most: float) -> int:
    """Shards of a key: the least power of two that leaves none above ``most``."""
    return 1 << max(math.ceil(math.log2(load / most)), 0) if load > most else 1


def place(within: Column) -> Column:
    """The 64-bit hash by which the rows of a key are placed: a shard is a range of its leading bits."""
    return F.xxhash64(within, F.lit(23))


def bits_at(hash_: Column, skip: Column, take: Column) -> Column:
    """The number in ``take`` bits of a 64-bit hash behind the first ``skip``; 0 for no bits."""
    return F.when(take > 0, F.call_function("shiftrightunsigned", F.call_function("shiftleft", hash_, skip), 64 - take)).otherwise(0).cast("int")


@dataclass(frozen=True)
class FragmentPlan:
    """Where the fragments of each key go."""

    spark: SparkSession
    tasks: int
    total: int  # load of all keys together
    heavy: dict[str, list[int]]  # key -> task of each shard
    buckets: list[int]  # light bucket -> task
    loads: DataFrame  # __key, load

    def _routes(self) -> tuple[DataFrame, DataFrame]:
        heavy = self.spark.createDataFrame(
            [(k, t) for k, t in self.heavy.items()], f"`{KEY}` string, __shards array<int>"
        )
        light = self.spark.createDataFrame(list(enumerate(self.buckets)), "__bucket int, __light int")
        return F.broadcast(heavy), F.broadcast(light)

    def _routed(self, df: DataFrame, key: Column) -> DataFrame:
        heavy, light = self._routes()
        bucket = F.pmod(F.xxhash64(F.col(KEY), F.lit(11)), F.lit(len(self.buckets))).cast("int")
        return df.withColumn(KEY, key).join(heavy, KEY, "left").withColumn("__bucket", bucket).join(light, "__bucket")

    def fragment(self, df: DataFrame, key: Column, within: Column) -> DataFrame:
        """The large side; rows with equal ``within`` of a key share a shard. Null keys are dropped.

        ``__cut`` is the number of leading bits of ``place(within)`` that the key's shards are told apart by.
        """
        cut = F.coalesce(F.round(F.log2(F.size("__shards").cast("double"))).cast("int"), F.lit(0))
        out = self._routed(df.where(key.isNotNull()), key).withColumn(CUT, F.when(F.col("__shards").isNotNull(), cut).otherwise(0))
        out = out.withColumn(SHARD, bits_at(place(within), F.lit(0), F.col(CUT)))
        out = out.withColumn(TASK, F.coalesce(F.get("__shards", F.col(SHARD)), F.col("__light")))
        return out.drop("__shards", "__bucket", "__light").repartitionById(self.tasks, F.col(TASK))

    def replicate(self, df: DataFrame, key: Column) -> DataFrame:
        """The matching side, once for each shard of its key."""
        shards = F.coalesce("__shards", F.array("__light"))
        out = self._routed(df.where(key.isNotNull()), key).select("*", F.posexplode(shards).alias(SHARD, TASK))
        return out.drop("__shards", "__bucket", "__light").repartitionById(self.tasks, F.col(TASK))


def plan_of_loads(loads: DataFrame, tasks: int | None = None) -> FragmentPlan:
    """The plan for ``__key, load``, which is read more than once; each key has one row."""
    spark = loads.sparkSession
    total = loads.agg(F.sum("load")).first()[0] or 0
    tasks = tasks or task_count(spark)
    most = max(total / (tasks * SPREAD), 1.0)
    heavy = {r[0]: r[1] for r in loads.where(F.col("load") > most).collect()}  # < tasks * SPREAD rows
    buckets = tasks * BUCKETS
    light = dict.fromkeys(range(buckets), 0) | {
        r[0]: r[1]
        for r in loads.where(F.col("load") <= most)
        .groupBy(F.pmod(F.xxhash64(F.col(KEY), F.lit(11)), F.lit(buckets)).cast("int").alias("b"))
        .agg(F.sum("load"))
        .collect()
    }
    items: dict = {("", b): n for b, n in light.items()}
    parts = {k: shards_of(n, most) for k, n in heavy.items()}
    for k, n in heavy.items():
        items |= {("k" + k, i): n / parts[k] for i in range(parts[k])}
    where = pack(items, tasks)
    shards = {k: [where["k" + k, i] for i in range(parts[k])] for k in heavy}
    return FragmentPlan(spark, tasks, int(total), shards, [where["", b] for b in range(buckets)], loads)


def plan_fragments(df: DataFrame, key: Column, tasks: int | None = None) -> FragmentPlan:
    """Measure the load of each key of ``df`` and plan its fragments. An empty ``df`` gives a plan without heavy keys."""
    loads = checkpoint(
        df.where(key.isNotNull()).groupBy(key.cast("string").alias(KEY)).agg(F.count(F.lit(1)).alias("load"))
    )
    return plan_of_loads(loads, tasks)


def combined(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """Repeated rows made one: ``k, v, n`` for each key that is not null and each value, nulls being one value.

    Each task combines its own rows before they move, so a value that a third of all rows have, or that is null in
    them, costs one row a task. Pairs go by the hash of both, which no hot key can fill. Written to the
    checkpoint folder, as they are measured and then sent to their fragments.
    """
    rows = df.select(key.cast("string").alias("k"), value.alias("v")).where("k is not null")
    return checkpoint(rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")))


def distinct_per_key(df: DataFrame, key: Column, value: Column, match: DataFrame, match_key: Column) -> DataFrame:
    """Rows and distinct non-null values of each key of ``match``, without imbalance.

    Result: ``__key``, ``n_rows``, ``n_values``; one row for each distinct non-null key of ``match``, zeros
    where ``df`` has none. Rows of ``df`` with a null key count for no key; null values count as rows only.
    Fragments are made of distinct pairs of key and value, so their counts add up to exact distinct counts.
    """
    pairs = combined(df, key, value)
    keys = match.select(match_key.cast("string").alias("k")).where("k is not null").distinct()
    plan = plan_fragments(pairs, F.col("k"))
    big = plan.fragment(pairs, F.col("k"), F.col("v")).select(TASK, KEY, SHARD, "v", "n")
    per_shard = big.groupBy(TASK, KEY, SHARD).agg(F.sum("n").alias("n"), F.count("v").alias("d"))
    small = plan.replicate(keys, F.col("k")).select(TASK, KEY, SHARD)
    matched = small.join(per_shard, [TASK, KEY, SHARD], "left")
    zero = F.lit(0).cast("bigint")
    return matched.groupBy(KEY).agg(
        F.coalesce(F.sum("n"), zero).alias("n_rows"), F.coalesce(F.sum("d"), zero).alias("n_values")
    )
