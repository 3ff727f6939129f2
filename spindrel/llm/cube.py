"""Sample matching target category proportions, by the cube method.

A setting asks for ``need`` records of each category. Within a category a record's inclusion
probability depends only on its unit (here a sample): units give in proportion to what they may give at
most. The balancing variables are the indicators of the categories and of the units within them.

Flight. Indicators are nested, unit in category in setting, so the directions that leave them all unchanged are
spanned by the differences of two records of one unit. Each step goes along such a difference, up or down
with the chances that keep every record's probability, until one of the two records is taken or refused
(``flight``; all steps that do not touch each other go at once). Which records meet is fixed by a hash: records
stand at the leaves of the binary tree of the bits of their unit's and their own hash, and the record left
undecided under one branch meets the one of the other branch. Fragments (see ``operators.fragments``) are
branches of that tree, so how rows are spread over tasks does not change what is drawn.

Merging upward. Each fragment leaves one record of a unit undecided at most. These meet in their unit, then, as the
indicators of units are given up, the units of a category meet: branch by branch, and last in the whole category.
Landing: what is left is rounded, which breaks no count, as the needs are whole numbers. A unit's number of
records differs by less than one from its expectation in the first phase and by one more at most from then
on. The report has wanted and realised shares, and what could not be met.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrel.operators.fragments import CUT, KEY, SHARD, TASK, bits_at, combined, place, plan_fragments
from spindrel.runtime import checkpoint

_EPS = 1e-9
_ROWS_PER_GROUP = 250_000
_LOOSE_PER_GROUP = 50_000
_DRAWN = "setting_id bigint, category string, unit string, item string, seed bigint, uh bigint, ih bigint, p double"

_NONE = pd.DataFrame({c.split()[0]: np.array([], {"bigint": "int64", "double": "float64"}.get(c.split()[1], object)) for c in _DRAWN.split(", ")})


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits of each number (the finaliser of splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _leading(x: np.ndarray) -> np.ndarray:
    """Leading zero bits of 64-bit numbers; 64 for 0."""
    n = np.zeros(len(x), np.int64)
    x = x.copy()
    for step in (32, 16, 8, 4, 2, 1):
        small = x < (np.uint64(1) << np.uint64(64 - step))
        n += np.where(small, step, 0)
        x = np.where(small, x << np.uint64(step), x)
    return np.where(x == 0, 64, n)


def flight(block: np.ndarray, high: np.ndarray, low: np.ndarray, p: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Walk from ``p`` along differences of two records of one block until each has one undecided record at most.

    Rows are sorted by ``block, high, low``; ``high`` and ``low`` are the two words of a record's place in the tree. The
    sum of ``p`` in each block, and in each branch of the tree up to one undecided record, stays as it is; the
    expectation of each entry is its entry in ``p``. ``seed`` is constant within a block. The result depends
    on the records of a block only, and a branch that is walked first on its own gives the same end.
    """
    p = np.where(p < _EPS, 0.0, np.where(p > 1 - _EPS, 1.0, p))
    alive = np.flatnonzero((p > 0) & (p < 1))
    while len(alive) > 1:
        a, b = alive[:-1], alive[1:]
        upper = _leading(high[a] ^ high[b])
        common = np.where(upper < 64, upper, 64 + _leading(low[a] ^ low[b]))
        common = np.where(block[a] == block[b], common, -1)
        padded = np.r_[-1, common, -1]
        # The two nearest records of their branch: no other undecided one can come between or join before them.
        meet = np.flatnonzero((common >= 0) & (common > padded[:-2]) & (common >= padded[2:]))
        if not len(meet):
            break
        i, j = a[meet], b[meet]
        x, y = p[i], p[j]
        chance = _mixed(_mixed(_mixed(low[i] ^ seed[i]) ^ low[j]) ^ _mixed(high[i] ^ _mixed(high[j])))
        draw = (chance >> np.uint64(11)).astype(np.float64) / (1 << 53)
        s = x + y
        first = np.where(s <= 1, draw * s < x, draw * (2 - s) < 1 - y)
        keep = np.where(s <= 1, s, 1.0)
        p[i], p[j] = np.where(first, keep, s - keep), np.where(first, s - keep, keep)
        near = np.r_[i, j]
        p[near] = np.where(p[near] < _EPS, 0.0, np.where(p[near] > 1 - _EPS, 1.0, p[near]))
        alive = alive[(p[alive] > 0) & (p[alive] < 1)]
    return p


def _seeds(parts: list[tuple]) -> np.ndarray:
    """A number for each setting and its seed."""
    of = {x: int.from_bytes(hashlib.blake2b("\x1f".join(map(str, x)).encode(), digest_size=8).digest(), "big") for x in set(parts)}
    return np.array([of[x] for x in parts], np.uint64)


def _unsigned(x: pd.Series) -> np.ndarray:
    return x.to_numpy(np.int64).view(np.uint64)


def _first(items: pd.DataFrame, plans: pd.DataFrame) -> pd.DataFrame:
    """Flight within the units' parts of one group, for each setting that uses them."""
    if not len(items) or not len(plans):
        return _NONE
    items = items.assign(h=_unsigned(items["ih"])).sort_values([KEY, SHARD, "h", "item"], kind="stable")
    keys, shards = items[KEY].to_numpy(object), items[SHARD].to_numpy()
    edges = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (shards[1:] != shards[:-1]), True])
    spans = {(keys[a], shards[a]): (a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)}
    use = [(r, *spans[r.key, r.shard]) for r in plans.itertuples(index=False) if (r.key, r.shard) in spans and r.p > 0]
    if not use:
        return _NONE
    size = np.array([b - a for _, a, b in use])
    at = np.concatenate([np.arange(a, b) for _, a, b in use])
    spread = lambda v, kind: np.repeat(np.array(v, kind), size)
    block = np.repeat(np.arange(len(use)), size)
    seed = np.repeat(_seeds([(r.seed, r.setting_id) for r, _, _ in use]), size)
    low = items["h"].to_numpy(np.uint64)[at]
    uh = spread([r.uh for r, _, _ in use], np.int64)
    p = flight(block, uh.view(np.uint64), low, spread([r.p for r, _, _ in use], float), seed)
    out = pd.DataFrame({
        "setting_id": spread([r.setting_id for r, _, _ in use], np.int64), "category": spread([r.category for r, _, _ in use], object),
        "unit": keys[at], "item": items["item"].to_numpy(object)[at], "seed": spread([r.seed for r, _, _ in use], np.int64),
        "uh": uh, "ih": items["ih"].to_numpy(np.int64)[at], "p": p,
    })
    return out[out["p"] > 0]


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """Flight of undecided records that meet: in their unit, then in a branch of a category's units."""
    rows = rows.assign(high=_unsigned(rows["uh"]), low=_unsigned(rows["ih"]))
    rows = rows.sort_values(["setting_id", "category", "branch", "high", "low", "unit", "item"], kind="stable").reset_index(drop=True)
    block = rows.groupby(["setting_id", "category", "branch"], sort=False).ngroup().to_numpy()
    seed = _seeds(list(zip(rows["seed"], rows["setting_id"], strict=True)))
    p = flight(block, rows["high"].to_numpy(np.uint64), rows["low"].to_numpy(np.uint64), rows["p"].to_numpy(float), seed)
    return rows.assign(p=p)[lambda x: x["p"] > 0].drop(columns=["branch", "high", "low"])


def cube_sample(
    items: DataFrame, unit: Column, item: Column, units: DataFrame, targets: DataFrame, rows_per_group: int = _ROWS_PER_GROUP,
    loose_per_group: int = _LOOSE_PER_GROUP,
) -> tuple[DataFrame, DataFrame]:
    """Draw a balanced sample for every setting; returns ``(sample, report)``.

    ``items``: records, counted once for each distinct ``(unit, item)``; null units or items are left out.
    ``units``: ``setting_id, category, unit, most, seed`` - which units a setting may draw from for a category
    and at most how many records from each (null: all). ``targets``: ``setting_id, category, need``.
    ``sample`` has ``setting_id, category, unit, item``; it depends on these tables and seeds, and neither on the
    number of tasks nor on the sizes of groups. ``report`` has a row for each target: ``need``, ``available``,
    ``selected``, ``shortfall`` = need - selected, which is above 0 exactly where the available records do not
    suffice, ``wanted_share`` and ``realised_share`` of the setting's needs and selected records (0 where there are
    none) and ``imbalance`` = realised - wanted. Categories without a target are not drawn from. An empty
    table on either side gives an empty sample and a report of full shortfalls.
    """
    pairs = combined(items, unit, item.cast("string")).where("v is not null").select("k", F.col("v").alias("item"))
    plan = plan_fragments(pairs, F.col("k"))
    sizes = plan.loads.select(F.col(KEY).alias("unit"), F.col("load").alias("n"))
    # Parts of a task that fit one group: branches below those that tell the shards of a key apart.
    deep = max(math.ceil(math.log2(max(plan.total / plan.tasks / rows_per_group, 1))), 0)
    pieces = plan.fragment(pairs, F.col("k"), F.col("item")).withColumn("ih", place(F.col("item")))
    pieces = pieces.select(TASK, bits_at(F.col("ih"), F.col(CUT), F.lit(deep)).alias("sub"), KEY, SHARD, "item", "ih")

    zero = F.lit(0).cast("bigint")
    units = units.select("setting_id", "category", "unit", "most", F.coalesce(F.col("seed").cast("bigint"), zero).alias("seed"))
    uses = units.join(targets.select("setting_id", "category", "need"), ["setting_id", "category"]).join(sizes, "unit")
    uses = uses.withColumn("give", F.least("n", F.greatest(F.coalesce(F.col("most").cast("bigint"), F.col("n")), zero)))
    per_category = uses.groupBy("setting_id", "category").agg(F.sum("give").alias("available"))
    chance = F.when(F.col("need") >= F.col("available"), F.col("give") / F.col("n")).otherwise(
        F.col("need") * (F.col("give") / F.col("available")) / F.col("n")
    )
    uses = uses.join(per_category, ["setting_id", "category"]).where("give > 0 and need > 0").withColumn("p", chance)
    matched = plan.replicate(uses.select("setting_id", "category", "unit", "p", "seed", F.xxhash64("unit", F.lit(29)).alias("uh")), F.col("unit"))
    matched = matched.select(
        TASK, F.explode(F.sequence(F.lit(0), F.lit((1 << deep) - 1))).alias("sub"), F.col(KEY).alias("key"), F.col(SHARD).alias("shard"),
        "setting_id", "category", "p", "seed", "uh",
    )
    drawn = checkpoint(pieces.groupBy(TASK, "sub").cogroup(matched.groupBy(TASK, "sub")).applyInPandas(_first, _DRAWN))

    loose = drawn.where("p < 1")
    n = loose.count()
    groups = max(plan.tasks, math.ceil(n / loose_per_group))
    bits = max(math.ceil(math.log2(max(n / loose_per_group, 1))), 0)

    def merged(rows: DataFrame, width: int) -> DataFrame:
        rows = rows.withColumn("branch", bits_at(F.col("uh"), F.lit(0), F.lit(width)))
        group = F.pmod(F.xxhash64("setting_id", "category", "branch", F.lit(13)), F.lit(groups)).alias("g")
        return rows.groupBy(group).applyInPandas(_merge, _DRAWN)

    sample = drawn.where("p >= 1")
    if bits:
        branches = checkpoint(merged(loose, bits))
        sample, loose = sample.unionByName(branches.where("p >= 1")), branches.where("p < 1")
    sample = sample.unionByName(merged(loose, 0).where("p >= 0.5")).select("setting_id", "category", "unit", "item")
    counts = sample.groupBy("setting_id", "category").agg(F.count(F.lit(1)).alias("selected"))
    report = (
        targets.select("setting_id", "category", F.col("need").cast("bigint").alias("need"))
        .join(per_category, ["setting_id", "category"], "left").join(counts, ["setting_id", "category"], "left")
        .select(
            "setting_id", "category", "need", F.coalesce("available", zero).alias("available"),
            F.coalesce("selected", zero).alias("selected"),
            (F.col("need") - F.coalesce("selected", zero)).alias("shortfall"),
        )
    )
    totals = report.groupBy("setting_id").agg(F.sum("need").alias("__need"), F.sum("selected").alias("__selected"))
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col(f"__{c}")), F.lit(0.0))
    report = report.join(totals, "setting_id").select(
        *report.columns, share("need").alias("wanted_share"), share("selected").alias("realised_share"),
        (share("selected") - share("need")).alias("imbalance"),
    )
    return sample, report


def unit_balance(sample: DataFrame, units: DataFrame, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Records drawn from each unit of a setting against their expectation: ``expected``, ``drawn``, ``off``.

    ``sizes(unit, n)`` has the distinct records of each unit; units, targets and sample are those of ``cube_sample``.
    """
    n = F.least("n", F.greatest(F.coalesce(F.col("most").cast("bigint"), F.col("n")), F.lit(0).cast("bigint")))
    uses = units.join(targets, ["setting_id", "category"]).join(sizes, "unit").withColumn("give", n)
    all_ = uses.groupBy("setting_id", "category").agg(F.sum("give").alias("available"))
    expected = F.least(F.col("need"), F.col("available")) * F.try_divide(F.col("give"), F.col("available"))
    drawn = sample.groupBy("setting_id", "category", "unit").agg(F.count(F.lit(1)).alias("drawn"))
    out = uses.join(all_, ["setting_id", "category"]).join(drawn, ["setting_id", "category", "unit"], "left")
    out = out.select("setting_id", "category", "unit", F.coalesce(expected, F.lit(0.0)).alias("expected"), F.coalesce("drawn", F.lit(0).cast("bigint")).alias("drawn"))
    return out.withColumn("off", F.col("drawn") - F.col("expected"))
