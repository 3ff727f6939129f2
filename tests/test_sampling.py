from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrel.operators import expression, quality, sampling, stats


def cells(spark, n=4000):
    return spark.range(n).select(F.col("id").alias("cell"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 7).cast("string")).alias("s"), F.lit(0).alias("rank"))


def test_per_stratum_takes_the_first_by_hash(spark):
    df = cells(spark)
    want = {}
    for r in df.withColumn("h", sampling.draw("cell", 42)).collect():
        want.setdefault(r["s"], []).append((r["h"], r["cell"]))
    for limit in (0, 1, 37, 10**6):
        got = sampling.per_stratum(df, "cell", "s", F.lit(limit)).collect()
        assert {r["cell"] for r in got} == {c for own in want.values() for _, c in sorted(own)[:limit]}
    assert sampling.per_stratum(df, "cell", "s", F.lit(None)).count() == 0
    assert sampling.per_stratum(df.limit(0), "cell", "s", F.lit(3)).count() == 0


@pytest.mark.parametrize("n", [0, 5, 1000, 10**7])
def test_sample_n(spark, n):
    df = cells(spark)
    order = [r["cell"] for r in df.orderBy(sampling.draw("cell", 7), "cell").collect()]
    assert {r["cell"] for r in sampling.sample_n(df, "cell", n, 7).collect()} == set(order[:n])


def test_stratified_counts(spark):
    df = cells(spark).where("s is not null")
    got = Counter(r["s"] for r in sampling.stratified(df, "cell", "s", 500).collect())
    shares = {r["s"]: r["n_sample"] for r in sampling.allocation(df, "s", 500).collect()}
    assert got == shares and sum(got.values()) == 500


@pytest.mark.parametrize("bad", ["a; drop", "reflect('x')", "java_method(1)", "secret > 1", "a > (select 1)", "a > $x", "cell(1)", "'open"])
def test_predicates_are_checked(spark, bad):
    df = spark.createDataFrame([(1, "x")], "a int, `b c` string")
    with pytest.raises(ValueError):
        sampling.selected(df, predicate=bad)


def test_predicates_and_formulas(spark):
    df = spark.createDataFrame([(1, "x", 4.0), (2, "it's", None)], "a int, `b c` string, v double")
    assert sampling.selected(df, predicate="a >= 1 and `b c` in ('x', 'y') AND not v is null").count() == 1
    assert sampling.selected(df, "a", [2], " ").count() == 1
    got = sampling.formulas(df, {"q": "try_divide(v, a - 1)", "r": "coalesce(v, 0) + a * 2"}).orderBy("a").collect()
    assert [(r["q"], r["r"]) for r in got] == [(None, 6.0), (None, 4.0)]


@pytest.mark.parametrize("in_memory", [200_000, 5])
def test_quantiles(spark, in_memory):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(3, 2, 300), np.full(200, 7.0), [0.0, -5.0, 1e9]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
    at = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    assert stats.quantiles(df, "v", at, in_memory, 8) == pytest.approx(list(np.quantile(x, at)))
    assert stats.quantiles(df.limit(0), "v", [0.5]) == [None]
    row = quality.mad_limits(df, "v", 3).first()
    assert row["median"] == pytest.approx(np.median(x)) and row["mad"] == pytest.approx(np.median(np.abs(x - np.median(x))) * quality.SIGMA)


def test_accessibility_background(spark):
    rng = np.random.default_rng(2)
    rows = [(c, f"p{p}", float(rng.integers(1, 9) * (3 if p == 0 and c < 100 else 1))) for c in range(300) for p in range(6) if rng.random() < 0.8]
    labels = spark.createDataFrame([(c, "a" if c < 100 else "b" if c < 200 else "c") for c in range(300)], "cell_id bigint, grp string")
    out = expression.differential_accessibility(spark.createDataFrame(rows, "cell_id bigint, gene_id string, value double"), labels, bins=5, background=50).collect()
    got = {(r["grp"], r["gene_id"]): r for r in out}
    assert len(got) == 18 and got["a", "p0"]["log2fc"] == max(r["log2fc"] for r in out) > 0.5
    norm = {}
    for c, p, v in rows:
        norm.setdefault(c, {})[p] = v
    logs = {c: {p: np.log1p(v * 1e4 / sum(own.values())) for p, v in own.items()} for c, own in norm.items()}
    inside = np.mean([logs.get(c, {}).get("p0", 0.0) for c in range(100)])
    assert got["a", "p0"]["mean_in"] == pytest.approx(inside)
    again = {(r["grp"], r["gene_id"]): r["log2fc"] for r in expression.differential_accessibility(spark.createDataFrame(rows, "cell_id bigint, gene_id string, value double").repartition(7), labels, bins=5, background=50).collect()}
    assert all(again[k] == pytest.approx(r["log2fc"]) for k, r in got.items())
