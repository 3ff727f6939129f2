from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spindrel.operators.fragments import BUCKETS, KEY, SPREAD, TASK, combined, distinct_per_key, pack, plan_fragments, plan_of_loads, shards_of

SCHEMA = "k string, v string, extra int"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows, keys):
    n, values = Counter(), defaultdict(set)
    for k, v, _ in rows:
        n[k] += 1
        if v is not None:
            values[k].add(v)
    return {(k, n[k], len(values[k])) for k in keys if k is not None}


@pytest.mark.parametrize("hot", [0, 400, 3000])
def test_distinct_per_key(spark, hot):
    rows = [(f"k{i % 17}", f"v{i % 29}", i) for i in range(600)] + [("hot", f"v{i % 1500}", 0) for i in range(hot)]
    rows += [(None, "v", 1), ("k1", None, 1), ("", "v", 2), ("k1", "v1", 3), ("k1", "v1", 3)]
    keys = ["hot", "k1", "k2", "none", None, "", "k1"]
    match = spark.createDataFrame([(k,) for k in keys], "key string")
    out = distinct_per_key(rows_of(spark, rows), F.col("k"), F.col("v"), match, F.col("key"))
    assert {tuple(r) for r in out.collect()} == brute(rows, set(keys))
    assert out.count() == len({k for k in keys if k is not None})


def test_empty_sides(spark):
    none, one = rows_of(spark, []), rows_of(spark, [("a", "x", 1)])
    keys = spark.createDataFrame([("a",)], "key string")
    got = lambda r, m: [tuple(x) for x in distinct_per_key(r, F.col("k"), F.col("v"), m, F.col("key")).collect()]
    assert got(none, keys) == [("a", 0, 0)]
    assert got(one, keys.limit(0)) == []


def test_heavy_key_is_spread(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").cast("string").alias("v"))
    plan = plan_fragments(rows, F.col("k"), tasks=4)
    assert set(plan.heavy) == {"hot"} and len(plan.heavy["hot"]) >= SPREAD and len(plan.buckets) == 4 * BUCKETS
    sizes = [r["count"] for r in plan.fragment(rows, F.col("k"), F.col("v")).groupBy(TASK).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 1.2 * 40_000 / 4


def test_pack_is_even_and_stable():
    loads = {("x", i): (i * 7919) % 100 + 1 for i in range(200)}
    where = pack(loads, 8)
    assert where == pack(dict(reversed(loads.items())), 8)
    used = Counter()
    for k, t in where.items():
        used[t] += loads[k]
    assert max(used.values()) - min(used.values()) <= 100


@pytest.mark.parametrize("value", [None, "same"])
def test_repeated_values_of_a_heavy_key_are_combined(spark, value):
    rows = spark.range(30_000).select(F.lit("hot").alias("k"), F.lit(value).cast("string").alias("v"), F.lit(1).alias("extra"))
    assert [tuple(r) for r in combined(rows, F.col("k"), F.col("v")).collect()] == [("hot", value, 30_000)]
    match = spark.createDataFrame([("hot",)], "key string")
    out = distinct_per_key(rows, F.col("k"), F.col("v"), match, F.col("key"))
    assert [tuple(r) for r in out.collect()] == [("hot", 30_000, int(value is not None))]


def test_plan_does_not_grow_with_the_rows(spark):
    claimed = spark.range(5_000).select(F.col("id").cast("string").alias(KEY), F.when(F.col("id") == 7, 5 * 10**11).otherwise(1.2e8).cast("bigint").alias("load"))
    plan = plan_of_loads(claimed, tasks=16)
    assert plan.total > 10**12 and plan.tasks == 16 and len(plan.buckets) == 16 * BUCKETS
    assert set(plan.heavy) == {"7"} and SPREAD * 4 <= len(plan.heavy["7"]) <= 2 * SPREAD * 16 and set(plan.heavy["7"]) == set(range(16))
    assert [shards_of(n, 10) for n in (1, 10, 11, 20, 21, 80)] == [1, 1, 2, 2, 4, 8]
