import random

import numpy as np
import pytest

from spindrel.llm import leaks, words


def test_words():
    assert words.words("Ca\u00adt\u200b's ＦＯＯ_bar x2\n３ é") == ["cat", "s", "foo", "bar", "x2", "3", "é"]
    assert words.words(None) == [] and words.words(" \n") == []
    long = "alpha beta " * 200_000
    assert words.words(long) == ["alpha", "beta"] * 200_000
    h = words.WordHash()
    for t in ("Plain ascii, text-1 a_b", "Ünïcödé 漢字 text"):
        assert h.array(t).tolist() == [h[w.encode()] for w in words.words(t)]


@pytest.mark.parametrize("size", [1, 8, 12])
def test_simhash_of_windows(size):
    h = np.random.default_rng(1).integers(0, 2**63, 50, dtype=np.uint64)
    got = leaks.simhashes(leaks.bit_sums(h), size)
    for i, fp in enumerate(got):
        bits = [sum(int(x) >> b & 1 for x in h[i : i + size]) * 2 > size - size % 2 if size % 2 == 0 else sum(int(x) >> b & 1 for x in h[i : i + size]) > size // 2 for b in range(64)]
        assert int(fp) == sum(v << b for b, v in enumerate(bits))


@pytest.mark.parametrize(("radius", "blocks"), [(0, 2), (1, 2), (3, 4), (7, 4), (9, 4)])
def test_blocks_find_all_within_radius(radius, blocks):
    rng = random.Random(radius)
    hash_ = words.WordHash()
    texts = [hash_.array(" ".join(f"w{rng.randrange(40)}" for _ in range(30))) for _ in range(20)]
    index = leaks.Windows(12, texts, [(k, o) for k in range(20) for o in range(19)], radius, blocks)
    probes = index.fp.copy()
    for i in range(len(probes)):
        for b in rng.sample(range(64), radius + i % 2):
            probes[i] ^= np.uint64(1 << b)
    a, b = index.candidates(probes)
    near = {(i, j) for i in range(len(probes)) for j in range(len(index.fp)) if bin(int(probes[i]) ^ int(index.fp[j])).count("1") <= radius}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == near


def changed(rng, text, every):
    return [f"x{rng.randrange(9999)}" if i % every == every // 2 else w for i, w in enumerate(text)]


@pytest.mark.parametrize("every", [200, 60, 45, 30, 15, 6])
def test_recall_of_changed_passages(every):
    """Against all pairs of a window of the index and one of the document with a similarity of 0.8."""
    rng = random.Random(every)
    items = [[f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 60, 110, 210]))] for _ in range(60)]
    index = leaks.LeakIndex([(i, " ".join(t)) for i, t in enumerate(items)])
    hash_ = words.WordHash()
    noise = lambda n: [f"n{rng.randrange(3000)}" for _ in range(n)]
    docs = [hash_.array(" ".join(noise(20) + changed(rng, t, every) + noise(20))) for t in items]
    got = {(d, i) for d, i, *_ in leaks._scan(index, np.arange(len(docs)), docs, leaks.SIMILARITY)}
    want = set()
    for d, x in enumerate(docs):
        k = d  # the other items share next to nothing with it
        for w in index.windows:
            for owners in w.owners:
                for j, o in owners:
                    if j == k and any(index.similarity(x[a : a + w.size], index.texts[k][o : o + w.size]) >= leaks.SIMILARITY for a in range(max(20 + o - 6, 0), min(20 + o + 7, len(x) - w.size + 1))):
                        want.add((d, k))
    assert len(got & want) >= 0.9 * len(want) and got <= want | {(d, d) for d in range(len(docs))}
    assert every == 6 or len(want) > 5


def test_repeated_words_make_no_pairs():
    text = "one two " * 3000
    index = leaks.LeakIndex([(1, text), (2, "one two " * 6)])
    assert max(len(w.owners) for w in index.windows) <= 2
    out = leaks._scan(index, np.array([7]), [words.WordHash().array(text)], leaks.SIMILARITY)
    assert {(d, i, s, share) for d, i, _, _, s, share in out} == {(7, 1, 1.0, 1.0), (7, 2, 1.0, 1.0)}


def brute(docs, items, window=12):
    out = set()
    for i, t in items:
        w = words.words(t)
        n = min(window, len(w))
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        for d, x in docs:
            v = words.words(x)
            if any(tuple(v[k : k + n]) in grams for k in range(len(v) - n + 1) if n):
                out.add((d, i))
    return out


@pytest.mark.parametrize("block_chars", [10**7, 300])
def test_against_brute_force(spark, block_chars):
    rng = random.Random(block_chars)
    line = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    items = [(i, " ".join(line(rng.choice([3, 8, 11, 12, 13, 60])))) for i in range(25)] + [(100, None), (101, " "), (102, "..."), (1, "w1 w2 w3")]
    docs = []
    for d in range(60):
        w = line(rng.choice([0, 5, 40, 300]))
        for i in rng.sample(range(25), 2):
            part = words.words(items[i][1])
            a = rng.randrange(len(part))
            at = rng.randrange(len(w) + 1)
            w[at:at] = part[a : a + rng.choice([11, 12, 20])]
        docs.append((d, "\u200b, ".join(x.upper() if rng.random() < 0.3 else x for x in w)))
    docs += [(200, None), (201, ""), docs[3], (202, " ".join(line(40_000)) + " " + items[5][1])]
    frame = lambda rows, key: spark.createDataFrame([(*r, 0) for r in rows], f"{key} bigint, text string, n_exact int")
    every = leaks.find_leaks(frame(docs, "doc_id"), frame(items, "item_id"), block_chars=block_chars)
    got = every.where("n_exact > 0")
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute(docs, items)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert leaks.find_leaks(docs.limit(0), items).count() == 0 and leaks.find_leaks(docs, items.limit(0)).count() == 0
    assert leaks.find_leaks(docs, items).first()["item_share"] == 1.0
