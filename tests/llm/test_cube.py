from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrel.llm import cube


def walk(block, p, seed=1, words=None):
    block = np.asarray(block)
    high, low = words or np.random.default_rng(5).integers(0, 2**63, (2, len(block)), dtype=np.uint64)
    order = np.lexsort((low, high, block))
    out = np.empty(len(block))
    out[order] = cube.flight(block[order], high[order], low[order], np.asarray(p, float)[order], np.full(len(block), seed, np.uint64))
    return out


def test_leading_zeros():
    x = np.array([0, 1, 2, 3, 2**31, 2**32, 2**63, 2**64 - 1], np.uint64)
    assert cube._leading(x).tolist() == [64 - int(v).bit_length() for v in x]


def test_flight_settles_records_and_keeps_the_indicators():
    rng = np.random.default_rng(1)
    block = np.sort(rng.integers(0, 7, 5000))
    p = rng.uniform(0, 1, 5000)
    out = walk(block, p)
    open_ = (out > 1e-9) & (out < 1 - 1e-9)
    assert np.allclose(np.bincount(block, out), np.bincount(block, p))
    assert np.bincount(block[open_], minlength=7).max() <= 1 and ((out == 0) | (out == 1)).sum() >= 5000 - 7
    assert len(walk([], [])) == 0 and walk([0], [0.4]).tolist() == [0.4]


def test_flight_keeps_probabilities():
    p = np.array([0.2, 0.5, 0.5, 0.8, 1.0, 0.0])
    mean = sum(walk([0] * 6, p, seed) for seed in range(4000)) / 4000
    assert np.abs(mean - p).max() < 0.04
    same = (np.zeros(6, np.uint64), np.zeros(6, np.uint64))  # even if all hashes are the same
    assert walk([0] * 6, p, words=same).sum() == pytest.approx(3.0)


def test_branches_first_or_at_once_is_the_same():
    rng = np.random.default_rng(3)
    p = rng.uniform(0, 1, 400)
    high, low = np.repeat(rng.integers(0, 2**63, 20, dtype=np.uint64) * np.uint64(2), 20), rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2)
    order = np.lexsort((low, high))
    high, low, seed = high[order], low[order], np.full(400, 9, np.uint64)
    at_once = cube.flight(np.zeros(400, int), high, low, p, seed)
    parts = np.unique(np.stack([high, low >> np.uint64(62)], 1), axis=0, return_inverse=True)[1]
    first = cube.flight(parts, high, low, p, seed)
    assert np.allclose(cube.flight(np.zeros(400, int), high, low, first, seed), at_once)


def draw(spark, cells, units, targets):
    items = spark.createDataFrame(cells, "u string, i string, n int, give int")
    units = spark.createDataFrame(units, "setting_id bigint, category string, unit string, most int, seed int")
    targets = spark.createDataFrame(targets, "setting_id bigint, category string, need bigint")
    sample, report = cube.cube_sample(items, F.col("u"), F.col("i"), units, targets)
    return [tuple(r) for r in sample.collect()], {(r["setting_id"], r["category"]): r.asDict() for r in report.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counts_are_met_and_limits_kept(spark, seed):
    cells = [(f"u{k}", f"c{i}", 0, 0) for k in range(12) for i in range(37 * (k + 1))]
    cells += [("hot", f"h{i}", 0, 0) for i in range(4000)] + cells[:50] + [(None, "x", 0, 0), ("u1", None, 0, 0)]
    units = [(1, "a" if k % 2 else "b", f"u{k}", 20, seed) for k in range(12)] + [(1, "a", "hot", None, seed), (2, "h", "hot", 100, seed)]
    targets = [(1, "a", 777), (1, "b", 500), (2, "h", 99), (2, "nothing", 4), (3, "x", 0)]
    sample, report = draw(spark, cells, units, targets)
    assert len(set(sample)) == len(sample) and {(u, i) for _, _, u, i in sample} <= {(u, i) for u, i, _, _ in cells}
    got = Counter((s, c) for s, c, _, _ in sample)
    assert got[1, "a"] == 777 and got[2, "h"] == 99
    assert report[1, "b"]["available"] == 120 and report[1, "b"]["selected"] == 120 and report[1, "b"]["shortfall"] == 380
    assert report[2, "nothing"]["shortfall"] == 4 and report[3, "x"]["shortfall"] == 0 and len(report) == 5
    per_unit = Counter((s, u) for s, _, u, _ in sample)
    assert all(n <= 20 for (s, u), n in per_unit.items() if u != "hot") and per_unit[2, "hot"] <= 100


def test_empty(spark):
    sample, report = draw(spark, [], [(1, "a", "u", None, 1)], [(1, "a", 3)])
    assert sample == [] and report[1, "a"]["shortfall"] == 3
    assert draw(spark, [("u", "i", 0, 0)], [], []) == ([], {})


def test_the_draw_does_not_depend_on_tasks_and_units_keep_their_totals(spark):
    cells = [(f"u{k}", f"c{i}", 0, 0) for k in range(40) for i in range(31 + 13 * k)] + [("hot", f"h{i}", 0, 0) for i in range(9000)]
    items = spark.createDataFrame(cells, "u string, i string, n int, give int").cache()
    units = spark.createDataFrame([(s, "ab"[k % 2], f"u{k}", 150, 7) for s in (1, 2) for k in range(40)] + [(1, "a", "hot", None, 7)], "setting_id bigint, category string, unit string, most int, seed int")
    targets = spark.createDataFrame([(1, "a", 3001), (1, "b", 1234), (2, "a", 555), (2, "b", 9999)], "setting_id bigint, category string, need bigint")
    sizes = items.groupBy(F.col("u").alias("unit")).agg(F.countDistinct("i").alias("n"))
    drawn = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for tasks, rows, loose in (("3", 250_000, 50_000), ("11", 500, 7)):
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            sample, report = cube.cube_sample(items, F.col("u"), F.col("i"), units, targets, rows, loose)
            drawn.append({tuple(r) for r in sample.collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert drawn[0] == drawn[1]
    balance = cube.unit_balance(sample, units, sizes, targets).collect()
    assert len(balance) == 81 and max(abs(r["off"]) for r in balance) < 2 and sum(abs(r["off"]) < 1 for r in balance) > 70
    by = {(r["setting_id"], r["category"]): r for r in report.collect()}
    assert by[1, "a"]["selected"] == 3001 and by[2, "b"]["shortfall"] == by[2, "b"]["need"] - by[2, "b"]["available"]
    assert by[1, "a"]["wanted_share"] == pytest.approx(3001 / 4235) and sum(by[2, c]["realised_share"] for c in "ab") == pytest.approx(1)
