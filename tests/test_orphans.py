import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spindrel.functions.paths import locate, resolve
from spindrel.operators.orphans import orphan_references

T = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(40)]
REFS, LIVES = "id string, k string, at timestamp, start int", "k string, s timestamp, e timestamp, at int"


def found(spark, refs, lives, **kw):
    r = spark.createDataFrame([(*x, 0) for x in refs], REFS)
    p = spark.createDataFrame([(*x, 0) for x in lives], LIVES)
    out = orphan_references(r, F.col("id"), F.col("k"), F.col("at"), p, F.col("k"), F.col("s"), F.col("e"), **kw)
    return sorted(x[0] for x in out.collect())


def brute(refs, lives):
    live = lambda k, at: at is not None and any(a == k and s is not None and s <= at and (e is None or at < e) for a, s, e in lives)
    return sorted(i for i, k, at in refs if k is not None and not live(k, at))


@pytest.mark.parametrize("target", [5, 60, 200_000])
def test_against_brute_force(spark, target):
    rng = random.Random(target)
    key = lambda: "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", "", "dé"])
    refs = [(f"r{i}", key() if rng.random() > 0.05 else None, rng.choice([*T, None])) for i in range(400)]
    lives = [(key(), rng.choice([*T, None]), rng.choice([*T, None])) for _ in range(120)]
    lives += lives[:10]
    assert found(spark, refs, lives, target_rows=target) == brute(refs, lives)


def test_borders_and_empty(spark):
    refs = [("start", "a", T[1]), ("end", "a", T[2]), ("before", "a", T[0]), ("later", "a", T[9])]
    assert found(spark, refs, [("a", T[1], T[2])]) == ["before", "end", "later"]
    assert found(spark, refs, []) == sorted(r[0] for r in refs)
    assert found(spark, [], [("a", T[1], None)]) == []
    assert found(spark, refs[:1], [("a", T[3], T[1])]) == ["start"]


@pytest.mark.parametrize(
    ("path", "want"),
    [("a\\b/./c//../d", "a/b/d"), ("../x/y", "../x/y"), ("a/../../b", "../b"), ("", ""), ("x.csv", "x.csv"), ("a/b", "a/b"), (None, None), ("a/..", "")],
)
def test_resolve(spark, path, want):
    assert spark.createDataFrame([(path,)], "p string").select(resolve(F.col("p"))).first()[0] == want


@pytest.mark.parametrize(
    ("path", "base", "want"),
    [(" projects/p/x\n", "d", "projects/p/x"), ("x", "projects/p", "projects/p/x"), ("../x", "projects/p/s", "projects/p/x"), ("a/../projects/y", "d", "projects/y"), ("x", None, "x")],
)
def test_locate(spark, path, base, want):
    df = spark.createDataFrame([(path, base)], "p string, b string")
    assert df.select(locate(F.col("p"), F.col("b"), "projects/")).first()[0] == want
