import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from spindrel.llm import packing


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    h = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(9)}
    lengths = sorted(h)
    cost = lambda bounds: sum(n * (min(b for b in bounds if b >= x) - x) for x, n in h.items())
    for k in (1, 2, 3):
        best = min(cost([*c, lengths[-1]]) for c in itertools.combinations(lengths[:-1], min(k - 1, len(lengths) - 1)))
        got = packing.bucket_bounds(h, k)
        assert len(got) <= k and got[-1] == lengths[-1] and cost(got) == best
    assert packing.bucket_bounds({}, 3) == []


def test_fill():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(5.5, 1, 5000).astype(int) + 1, 2048)
    bounds = packing.bucket_bounds(dict(Counter(lengths.tolist())), 16)
    container, bucket = packing.fill(lengths, bounds, 2048)
    used = np.bincount(container, lengths)
    assert used.max() <= 2048 and (used > 0).all() and used.sum() / (len(used) * 2048) > 0.99
    assert (bucket >= lengths).all() and set(bucket.tolist()) <= set(bounds)


def test_bounds_shape_the_containers():
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.lognormal(5.5, 1, 5000).astype(int) + 1, 2048)
    unused = {}
    for buckets in (1, 2, 16):
        bounds = packing.bucket_bounds(dict(Counter(lengths.tolist())), buckets)
        container, _ = packing.fill(lengths, bounds, 2048)
        unused[buckets] = 1 - lengths.sum() / ((container.max() + 1) * 2048)
    assert unused[16] < 0.01 < unused[1] and unused[16] < unused[2] < unused[1]
    # Within a bucket that gets no room from above, batches are runs of neighbouring lengths.
    container, _ = packing.fill(np.array([900, 1000, 300, 310, 320, 330]), [330, 1000], 1000)
    assert container.tolist() == [1, 0, 3, 2, 2, 2]
    assert len(packing.fill(np.array([], int), [], 10)[0]) == 0


def test_pack(spark):
    texts = [(1, "one two three " * 400), (2, "word"), (3, ""), (4, None), (5, "   "), (2, "word"), (6, "ü漢字 " * 50), (None, "some text")]
    docs = spark.createDataFrame([(d, t, 0) for d, t in texts], "doc_id bigint, text string, n_tokens int")
    rows = packing.pack(docs, capacity=100, group_pieces=5).collect()
    tok = packing.tokenizer(packing.TOKENIZER)
    want, got, fill = Counter(), Counter(), defaultdict(int)
    for d, t in texts:
        want[d] += len(tok.encode_ordinary(t or ""))
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
        fill[r["container_id"]] += r["n_tokens"]
        assert r["token_start"] == r["piece"] * 100 and 0 < r["n_tokens"] <= 100 <= max(r["bucket"], 100)
    assert got == +want and max(fill.values()) <= 100
    assert sum(1 for r in rows if r["doc_id"] == 1 and r["n_tokens"] < 100) <= 1
    assert packing.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["a" + " " * 60 + "b c", " " * 50, "x\n" + "\n \t" * 20 + "\ny", "a" + " " * 40 + "\n", "no space", "", " " * 30 + "1" + " " * 30 + "漢"])
def test_long_white_space_counts_the_same(text):
    tok = packing.tokenizer(packing.TOKENIZER)
    assert packing.count_tokens(tok, text, longest=10) == len(tok.encode_ordinary(text))
    assert packing.count_tokens(tok, "a" + " " * 1_000_000 + "b") > 1
