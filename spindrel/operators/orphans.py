"""References to records that do not exist.

A reference ``(ref, key, at)`` is an orphan if no life ``[start, end)`` of its key holds its time. Lives and references
are range-partitioned together by their key, with bounds that are sampled from the keys. Within a range, sorted by
key, the lives of each key are two sorted arrays, starts and ends, and every batch of references is answered by
binary search, as the number of lives begun minus the number ended by its time.

These numbers add up, so a hot key is cut further: its references into ``r`` parts, its lives into ``p`` parts, and every
pair of parts is a slot of its own with its place in the order, which can lie in another range. Only there, the ``p`` answers
of a reference are summed. No slot exceeds the target by more than the unevenness of the hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrel.runtime import checkpoint, task_count

RANGES_MAX = 65_536
_FOREVER = np.iinfo(np.int64).max
_ANSWER = "rid string, key string, at bigint, parts int, live bigint"


def _probe(lives: pd.DataFrame, refs: pd.DataFrame) -> np.ndarray:
    """Lives of the reference's key and slot that hold its time, for each reference."""
    n = len(lives)
    code = pd.concat([lives[["key", "slot"]], refs[["key", "slot"]]], ignore_index=True).groupby(["key", "slot"], sort=False).ngroup().to_numpy()
    times, at = np.unique(
        np.concatenate([lives["start"].to_numpy(), lives["end"].to_numpy(), refs["start"].to_numpy()]), return_inverse=True
    )
    combined = lambda key, t: key.astype(np.int64) * (len(times) + 1) + t
    starts = np.sort(combined(code[:n], at[:n]))
    ends = np.sort(combined(code[:n], at[n : 2 * n]))
    probes = combined(code[n:], at[2 * n :])
    first = code[n:].astype(np.int64) * (len(times) + 1)
    begun = np.searchsorted(starts, probes, "right") - np.searchsorted(starts, first, "left")
    ended = np.searchsorted(ends, probes, "right") - np.searchsorted(ends, first, "left")
    return begun - ended


def _range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The answers of one range, sorted by key and slot with lives before references.

    Of what came in earlier batches only the lives of the last key and slot are kept.
    """
    kept: pd.DataFrame | None = None
    for b in batches:
        if not len(b):
            continue
        is_ref = b["is_ref"].to_numpy(bool)
        lives, refs = b[~is_ref], b[is_ref]
        if kept is not None:
            lives = pd.concat([kept, lives], ignore_index=True)
        last = b.iloc[-1]
        kept = lives[(lives["key"] == last["key"]) & (lives["slot"] == last["slot"])]
        if len(refs):
            out = pd.DataFrame({"rid": refs["rid"], "key": refs["key"], "at": refs["start"], "parts": refs["parts"], "live": _probe(lives, refs)})
            yield out[(out["live"] == 0) | (out["parts"] > 1)]


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def orphan_references(
    refs: DataFrame,
    ref_id: Column,
    ref_key: Column,
    ref_at: Column,
    lives: DataFrame,
    life_key: Column,
    start: Column,
    end: Column,
    target_rows: int = 200_000,
) -> DataFrame:
    """``rid`` (as string) and ``at`` of the references without a live target at their time.

    References are told apart by id, key and time. Those with a null key are none; those with a null time
    have no live target. A life with a null start never begins, one with a null end never ends, one that
    ends before or when it begins holds no time. Without any life every reference is an orphan.
    """
    spark = refs.sparkSession
    r = refs.select(ref_id.cast("string").alias("rid"), ref_key.cast("string").alias("key"), _micros(ref_at).alias("at")).where("key is not null").distinct()
    r = checkpoint(r)  # both sides are measured by key and probed
    p = checkpoint(lives.select(
        life_key.cast("string").alias("key"), _micros(start).alias("start"), F.coalesce(_micros(end), F.lit(_FOREVER)).alias("end")
    ).where("key is not null and start is not null and start < end").distinct())
    timeless = r.where("at is null").select("rid", F.lit(None).cast("timestamp").alias("at"))

    one = F.lit(1)
    per_key = lambda df, name: df.groupBy("key").agg(F.count(one).alias(name))
    counts = per_key(r, "n_r").join(per_key(p, "n_p"), "key", "full").na.fill(0, ["n_r", "n_p"])
    parts_of = lambda n: F.greatest(F.ceil(F.col(n) / target_rows), one).cast("int")
    hot = counts.where(F.greatest("n_r", "n_p") > 2 * target_rows).select("key", parts_of("n_r").alias("r_parts"), parts_of("n_p").alias("p_parts"))
    hot = F.broadcast(checkpoint(hot))  # a key in it has more than 2 * target_rows rows, so they are few
    rows = r.count() + p.count()
    ranges = min(max(-(-rows // target_rows), task_count(spark)), RANGES_MAX)

    cut = lambda df: df.join(hot, "key", "left").na.fill(1, ["r_parts", "p_parts"])
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    slot = F.col("r_part") * F.col("p_parts") + F.col("p_part")
    part = lambda of, n: F.pmod(of, F.col(n)).cast("int")
    refs_ = cut(r.where("at is not null")).withColumn("r_part", part(F.xxhash64("rid", "at", F.lit(5)), "r_parts")).withColumn("p_part", all_of("p_parts"))
    lives_ = cut(p).withColumn("p_part", part(F.xxhash64("start", "end", F.lit(7)), "p_parts")).withColumn("r_part", all_of("r_parts"))
    both = refs_.select("rid", "key", slot.alias("slot"), F.col("p_parts").alias("parts"), F.col("at").alias("start"), F.lit(0).cast("bigint").alias("end"), F.lit(True).alias("is_ref"))
    both = both.unionByName(lives_.select(F.lit(None).cast("string").alias("rid"), "key", slot.alias("slot"), F.col("p_parts").alias("parts"), "start", "end", F.lit(False).alias("is_ref")))
    ranged = both.repartitionByRange(ranges, "key", "slot").sortWithinPartitions("key", "slot", "is_ref")
    answers = ranged.mapInPandas(_range, _ANSWER)
    if not hot.isEmpty():
        answers = answers.groupBy("rid", "key", "at").agg(F.sum("live").alias("live")).where("live = 0")
    found = answers.select("rid", F.timestamp_micros("at").alias("at"))
    return found.unionByName(timeless)


def orphan_report(orphans: DataFrame, table: Column, at: Column) -> DataFrame:
    """Orphans per table and month (``yyyy-MM``; null for references without a time)."""
    return orphans.groupBy(table.alias("ref_table"), F.date_format(at, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orphans")
    )
