import random

import pytest
from pyspark.sql import functions as F

from spindrel.llm import topn

SCHEMA = "g string, score double, lfc double, name string, n int, bin int, rank int"


def run(spark, rows, part_rows, broadcast_groups=100_000):
    df = spark.createDataFrame(rows, SCHEMA)
    out = topn.top_per_group(df, ["g"], "score", [F.col("lfc").desc_nulls_last(), F.col("name").asc()], F.col("n"), F.col("name"), part_rows, broadcast_groups)
    return sorted((r["g"], r["rank"], r["name"]) for r in out.collect())


def brute(rows):
    out = []
    for g in {r[0] for r in rows if r[0] is not None}:
        own = [r for r in rows if r[0] == g and r[1] is not None and r[1] == r[1]]
        own.sort(key=lambda r: (-r[1], r[2] is None, -(r[2] or 0), r[3]))
        limit = own[0][4] if own else 0
        out += [(g, i + 1, r[3]) for i, r in enumerate(own[: limit or 0])]
    return sorted(out)


@pytest.mark.parametrize("part_rows", [10, 50, 100_000])
def test_against_sorting(spark, part_rows):
    rng = random.Random(part_rows)
    value = lambda: rng.choice([None, float("nan"), 0.0, 1.0, 1.0, rng.gauss(0, 50), float("inf"), -1e-9, 3.25])
    sizes = {"one": 1, "ties": 400, "wide": 700, "none": 30, "null limit": 20, "few": 3}
    limits = {"one": 5, "ties": 7, "wide": 60, "none": 0, "null limit": None, "few": 10}
    rows = []
    for g, size in sizes.items():
        for i in range(size):
            s = 2.5 if g == "ties" else value()
            rows.append((g, s, rng.choice([None, 1.0, 2.0]), f"{g}{i:04d}", limits[g], i, i))
    rows.append((None, 5.0, 1.0, "x", 9, 1, 1))
    assert run(spark, rows, part_rows) == run(spark, rows, part_rows, 0) == brute(rows)


def test_empty(spark):
    assert run(spark, [], 10) == []


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, 1, 5.0), ("a", 2, 2, 6.0), ("a", 2, 3, None), ("b", None, 4, 1.0)], "k string, at int, id int, v double")
    assert sorted(tuple(r) for r in topn.latest(df, ["k"], "at", "id", ["v"]).collect()) == [("a", None), ("b", 1.0)]
