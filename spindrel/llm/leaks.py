"""Evaluation texts leaking into training text.

Items are cut into windows of two kinds, and every document into all windows of the same sizes. Short windows, of
``WINDOW`` words at every place of the item (of all its words if it has fewer), find the passages that are there word for
word. Item-sized windows, of the largest of ``SIZES`` that the item has words for and a quarter of it apart, find
longer passages with changes. Each window has a 64-bit SimHash of its words, cut into blocks; two fingerprints that
differ in at most ``radius`` bits have a block in which they differ in ``radius // blocks`` at most. The index
holds each block's value and all values so near to it, so that looking up every block of a window finds
all fingerprints within the radius. Windows of the same words are one entry, however often they occur. Pairs
are verified by the exact similarity of their shingles, weighted by rarity among all items, and by their words.

A short window has eight shingles of five words. Without one of them the similarity is below 0.8, so that its radius is small;
the radius of item-sized windows is large.

Items are few and known, documents many: the index of a block of items, whose size is bounded, is sent
to the workers, and one pass over the documents answers all blocks, one after the other for each batch, without a shuffle.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.llm.words import WordHash
from spindrel.runtime import checkpoint

WINDOW = 12
SIZES = (24, 48, 96, 192)
SHORT_RADIUS, RADIUS = 1, 7
SHORT_BLOCKS, BLOCKS = 2, 4
SHINGLE = 5
SIMILARITY = 0.8
BLOCK_CHARS = 8_000_000
_CHUNK = 1 << 15
_FILTER_BITS = 20
_OUT = "doc_id bigint, item_id bigint, n_windows bigint, n_exact bigint, similarity double, item_share double"


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """Running counts of set bits, with a leading row of zeros: eight counters of a byte in each number.

    The counters overflow into each other, but differences of two rows are right in all of them as long as
    no window is longer than 255 words.
    """
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros((len(hashes) + 1, 8), np.uint64)
    np.cumsum(bits.view(np.uint64), axis=0, out=out[1:])
    return out


def simhashes(sums: np.ndarray, size: int) -> np.ndarray:
    """The SimHash of every window of ``size`` (up to 255) words: the bits set in more than half of them."""
    counts = (sums[size:] - sums[:-size]).view(np.uint8)
    return np.packbits(counts > size // 2, axis=1).view(">u8").ravel().astype(np.uint64)


def block_masks(blocks: int) -> list[tuple[int, int]]:
    """Shift and width of the blocks of a fingerprint."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _digest(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words (of all words if there are fewer)."""
    k = min(size, len(hashes))
    out = np.zeros(len(hashes) - k + 1 if k else 0, np.uint64)
    for i in range(k):
        out = (out ^ (out >> np.uint64(29))) * _FACTOR + hashes[i : i + len(out)]
    return out


class Windows:
    """The windows of one size: each content once, by fingerprint."""

    def __init__(self, size: int, texts: list[np.ndarray], places: list[tuple[int, int]], radius: int, blocks: int) -> None:
        self.size, self.radius = size, radius
        self.owners: list[list[tuple[int, int]]] = []  # content -> items and offsets
        known: dict[int, int] = {}
        prints: dict[int, np.ndarray] = {}
        fp: list[int] = []
        for k, o in places:
            text = texts[k]
            at = known.setdefault(_digest(text[o : o + size]), len(self.owners))
            if at == len(self.owners):
                if k not in prints:
                    prints[k] = simhashes(bit_sums(text), size)
                self.owners.append([])
                fp.append(int(prints[k][o]))
            self.owners[at].append((k, o))
        self.content = {v: h for h, v in known.items()}
        prints_ = np.array(fp, np.uint64)
        order = np.argsort(prints_, kind="stable")
        self.fp, first = np.unique(prints_[order], return_index=True)
        self.held = np.split(order, first[1:]) if len(order) else []  # fingerprint -> contents
        self.tables = []
        for shift, width in block_masks(blocks):
            value = (self.fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            flips = [0] + [sum(1 << x for x in c) for n in range(1, radius // blocks + 1) for c in itertools.combinations(range(width), n)]
            values = np.concatenate([value ^ np.uint64(x) for x in flips])
            entry = np.tile(np.arange(len(self.fp)), len(flips))
            order = np.argsort(values, kind="stable")
            low = ((1 << min(width, _FILTER_BITS)) - 1)
            seen = np.bincount((values & np.uint64(low)).astype(np.int64), minlength=low + 1) > 0
            starts = np.searchsorted(values[order], np.arange(low + 2, dtype=np.uint64)) if width <= _FILTER_BITS else None
            self.tables.append((shift, (1 << width) - 1, low, values[order], entry[order], seen, starts))

    def candidates(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a given fingerprint and one of the index (as places in both) within the radius."""
        codes = []
        for shift, mask, low, values, entry, seen, starts in self.tables:
            block = (fp >> np.uint64(shift)) & np.uint64(mask)
            at = (block & np.uint64(low)).astype(np.int64)
            some = np.flatnonzero(seen[at])
            if not len(some):
                continue
            if starts is None:
                first = np.searchsorted(values, block[some], "left")
                n = np.searchsorted(values, block[some], "right") - first
            else:
                first = starts[at[some]]
                n = starts[at[some] + 1] - first
            a = np.repeat(some, n)
            b = entry[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]
            near = np.bitwise_count(fp[a] ^ self.fp[b]) <= self.radius
            codes.append(a[near] * len(self.fp) + b[near])
        pairs = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.int64)
        return pairs // max(len(self.fp), 1), pairs % max(len(self.fp), 1)


class LeakIndex:
    """The windows of a block of items. ``counts`` has the number of items with each shingle, ``n_items`` that of all items."""

    def __init__(
        self, items: list[tuple[int, str | None]], window: int = WINDOW, radius: int = RADIUS, shingle: int = SHINGLE,
        counts: dict[int, int] | None = None, n_items: int | None = None, sizes: tuple[int, ...] = SIZES,
    ) -> None:
        self.shingle = shingle
        hash_ = WordHash()
        self.ids, self.texts = [], []
        for item_id, text in items:
            if len(h := hash_.array(text)):
                self.ids.append(item_id)
                self.texts.append(h)
        counts = Counter(s for t in self.texts for s in set(shingles(t, shingle).tolist())) if counts is None else counts
        n_items = len(self.texts) if n_items is None else n_items
        self.known = np.array(sorted(counts), np.uint64)
        self.weights = np.array([math.log(1 + n_items / counts[s]) for s in self.known.tolist()])
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.known & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        self.unseen = math.log(1 + n_items) if n_items else 1.0
        short: dict[int, list[tuple[int, int]]] = {}
        long: dict[int, list[tuple[int, int]]] = {}
        for k, t in enumerate(self.texts):
            n = len(t)
            size = min(window, n)
            short.setdefault(size, []).extend((k, o) for o in range(n - size + 1))
            if size := max((x for x in sizes if window < x <= n), default=0):
                long.setdefault(size, []).extend((k, o) for o in sorted({*range(0, n - size + 1, size // 4), n - size}))
        self.windows = [Windows(x, self.texts, at, min(SHORT_RADIUS, radius), SHORT_BLOCKS) for x, at in sorted(short.items())]
        self.windows += [Windows(x, self.texts, at, radius, BLOCKS) for x, at in sorted(long.items())]

    def weigh(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each shingle and whether some item has it."""
        weight, known = np.full(len(found), self.unseen), np.zeros(len(found), bool)
        some = np.flatnonzero(self.filter[(found & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        if len(some) and len(self.known):
            at = np.minimum(np.searchsorted(self.known, found[some]), len(self.known) - 1)
            hit = self.known[at] == found[some]
            weight[some[hit]], known[some[hit]] = self.weights[at[hit]], True
        return weight, known

    def similarity(self, a: np.ndarray, b: np.ndarray) -> float:
        """Weighted Jaccard similarity of the shingles of two windows, given as hashes of their words."""
        if np.array_equal(a, b):
            return 1.0
        x, y = (np.unique(shingles(w, self.shingle), return_counts=True) for w in (a, b))
        both, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
        common = np.minimum(x[1][i], y[1][j]) @ self.weigh(both)[0]
        return float(common / (x[1] @ self.weigh(x[0])[0] + y[1] @ self.weigh(y[0])[0] - common))


def _scan(index: LeakIndex, ids: np.ndarray, per_doc: list[np.ndarray], minimum: float) -> list[tuple]:
    """Verified pairs of a batch of documents, given as hashes of their words."""
    hashes = np.concatenate(per_doc) if per_doc else np.empty(0, np.uint64)
    lengths = np.array([len(x) for x in per_doc], np.int64)
    doc = np.repeat(np.arange(len(per_doc)), lengths)
    found: dict[tuple[int, int], list] = {}  # document and item -> places, exact places, similarity, words of the item
    longest = max((w.size for w in index.windows), default=0)
    verified: dict[tuple[int, int, int], float] = {}  # words of a document's window, size, content of the index
    for a in range(0, len(hashes), _CHUNK):
        part = hashes[a : a + _CHUNK + longest - 1]
        sums = bit_sums(part)
        of_known = of_other = None
        for w in index.windows:
            size = w.size
            if len(part) < size:
                continue
            at, to = w.candidates(simhashes(sums, size)[:_CHUNK])
            inside = doc[a + at] == doc[a + size - 1 + at]
            at, to = at[inside], to[inside]
            if not len(at):
                continue
            if size > index.shingle:
                # Shingles that no item has set a bound to the similarity, which spares most verifications.
                if of_known is None:
                    weight, known = index.weigh(shingles(part, index.shingle))
                    of_known, of_other = (np.concatenate([[0.0], np.cumsum(np.where(k, weight, 0.0))]) for k in (known, ~known))
                n = size - index.shingle + 1
                most, other = of_known[at + n] - of_known[at], of_other[at + n] - of_other[at]
                fair = most >= (minimum - 1e-9) * (most + other)
                at, to = at[fair], to[fair]
            for i, y in zip((a + at).tolist(), to.tolist(), strict=True):
                own, d = hashes[i : i + size], int(doc[i])
                digest = _digest(own)
                for c in w.held[y].tolist():
                    exact = w.content[c] == digest
                    if exact:
                        sim = 1.0
                    elif (sim := verified.get((digest, size, c), -1.0)) < 0:
                        k, o = w.owners[c][0]
                        sim = verified[digest, size, c] = index.similarity(own, index.texts[k][o : o + size])
                    if sim < minimum:
                        continue
                    for k in {k for k, _ in w.owners[c]}:
                        one = found.setdefault((d, k), [set(), set(), 0.0, set()])
                        one[0].add(i)
                        if exact:
                            one[1].add(i)
                        one[2] = max(one[2], sim)
                        one[3].add((size, c))
    out = []
    sized = {w.size: w for w in index.windows}
    for (d, k), (places, exact, sim, contents) in found.items():
        covered = np.zeros(len(index.texts[k]), bool)
        for size, c in contents:
            for j, o in sized[size].owners[c]:
                if j == k:
                    covered[o : o + size] = True
        out.append((ids[d], index.ids[k], len(places), len(exact), sim, float(covered.mean())))
    return out


def _shingles_of(known: DataFrame, shingle: int) -> DataFrame:
    """``b, h``: the distinct shingles of each item of ``known(i, t, b)``, with the number of its block."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hash_ = WordHash()
        for batch in batches:
            rows = [(b, x - (1 << 63)) for b, t in zip(batch["b"], batch["t"], strict=True) for x in set(shingles(hash_.array(t), shingle).tolist())]
            yield pd.DataFrame(rows, columns=["b", "h"]).astype("int64")

    return known.select("b", "t").mapInPandas(cut, "b bigint, h bigint")


def _indexes(known: DataFrame, window: int, radius: int, shingle: int, block_chars: int) -> Iterator[LeakIndex]:
    """The index of each block of items, one at a time."""
    n, chars = known.agg(F.count(F.lit(1)), F.sum(F.length("t"))).first()
    blocks = max(math.ceil((chars or 0) / block_chars), 1)
    block = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))  # about block_chars characters
    if blocks > 1:
        each = checkpoint(_shingles_of(known.withColumn("b", block), shingle))
        counts = each.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    for b in range(blocks):
        items = [(r[0], r[1]) for r in known.where(block == b).orderBy("i", "t").toLocalIterator()]
        if blocks == 1:
            yield LeakIndex(items, window, radius, shingle)
        else:
            own = each.where(F.col("b") == b).select("h").distinct().join(counts, "h")
            yield LeakIndex(items, window, radius, shingle, {r[0] + (1 << 63): r[1] for r in own.toLocalIterator()}, n)


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    radius: int = RADIUS,
    minimum: float = SIMILARITY,
    shingle: int = SHINGLE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Pairs of a document and an item that share a passage: ``window`` words as they are, or an item-sized window of
    at least ``minimum`` similarity whose fingerprint is within ``radius``.

    A row has the number of places in the document that match, of those that agree word for word (``n_exact``; words are
    compared by 64-bit hashes), the highest similarity and the share of the item's words within matches. Null and
    blank texts, texts without words and documents shorter than a window match nothing; an empty table gives an empty
    result. Repeated documents come out as often as they are there, repeated items once for each.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).cast("string").alias("t")).where(F.length("t") > 0)
    known = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).cast("string").alias("t")).where(F.length("t") > 0)
    sent = [spark.sparkContext.broadcast(index) for index in _indexes(known, window, radius, shingle, block_chars)]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hash_ = WordHash()
        for batch in batches:
            per_doc = [hash_.array(t) for t in batch["t"]]
            for index in sent:
                rows = _scan(index.value, batch["d"].to_numpy(object), per_doc, minimum)
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "n_windows", "n_exact", "similarity", "item_share"])
                if len(sent) > 1:  # one block in memory at a time
                    index.__dict__.pop("_value", None)

    return docs.mapInPandas(scan, _OUT)
