"""Filling fixed-capacity containers with texts, by optimal length buckets.

Texts are measured in tokens and those above the capacity cut into pieces. A histogram of the piece
lengths, which has at most as many entries as the capacity, gives by dynamic programming the bucket
boundaries that minimise padding. Batches with a token budget of the capacity form inside each bucket, the
longest bucket first: pieces of one bucket follow each other by length while the budget lasts. Only the room
that a batch has left then is handed down, to the next shorter bucket, whose pieces form batches of their
own after it is used. Pieces are spread over groups of bounded size by a hash, so that every group has the
whole mixture of lengths and leaves few containers partly filled.
"""

from __future__ import annotations

import bisect
import functools
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.runtime import checkpoint

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CAPACITY = 2048
BUCKETS = 16
GROUP_PIECES = 50_000
LONG_SPACE = 5_000


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):  # noqa: ANN201
    """The encoding of a file of ranks, loaded once in a worker."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(encoding, text: str, longest: int = LONG_SPACE) -> int:  # noqa: ANN001
    """Tokens of a text. The pattern gives up on very long white space, which is therefore cut out as it would cut it:
    all of it is one piece, but for the last character if something follows."""
    n, at = 0, 0
    for m in re.finditer(rf"\s{{{longest},}}", text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        n += len(encoding.encode_ordinary(text[at : m.start()])) + len(encoding._encode_single_piece(text[m.start() : end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:] if at else text))


def token_counts(documents: DataFrame, doc_id: str, text: str, path: str = TOKENIZER) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every text that is not null; whole texts are encoded.

    The file of ranks at ``path`` is sent to the workers, which need no copy of their own.
    """
    documents.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = tokenizer(SparkFiles.get(name))
        for b in batches:
            yield pd.DataFrame({"doc_id": b["d"], "n_tokens": [count_tokens(encoding, t) for t in b["t"]]})

    rows = documents.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).cast("string").alias("t")).where("t is not null")
    return rows.mapInPandas(count, "doc_id bigint, n_tokens bigint")


def bucket_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least sum of (bound - length) over all pieces."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    n = np.r_[0, np.cumsum([histogram[x] for x in lengths])].astype(float)
    s = np.r_[0, np.cumsum([histogram[x] * x for x in lengths])].astype(float)
    best = np.r_[0.0, np.full(len(lengths), np.inf)]
    back = []
    for _ in range(min(buckets, len(lengths))):
        new, choice = np.full(len(best), np.inf), np.zeros(len(best), int)
        new[0] = 0.0

        # The best start of a bucket never falls as its end rises, so each half has its own range of starts.
        todo = [(1, len(lengths), 0, len(lengths) - 1)]
        while todo:
            a, b, lo, hi = todo.pop()
            if a > b:
                continue
            j = (a + b) // 2
            i = np.arange(lo, min(hi, j - 1) + 1)
            cost = best[i] + lengths[j - 1] * (n[j] - n[i]) - (s[j] - s[i])
            k = int(cost.argmin())
            new[j], choice[j] = cost[k], i[k]
            todo += [(a, j - 1, lo, int(i[k])), (j + 1, b, int(i[k]), hi)]
        best = new
        back.append(choice)
    bounds, j = [], len(lengths)
    for choice in reversed(back):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
    return sorted(bounds)


def fill(lengths: np.ndarray, bounds: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container number and bucket bound of every piece (lengths from 1 to ``capacity``).

    Buckets come from the longest to the shortest. Batches of longer buckets that have room take the longest
    pieces of this bucket that fit; the pieces that remain form batches among themselves, one after the other by
    falling length while the token budget lasts. A batch never takes a piece of a longer bucket than its own.
    """
    container, bucket = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened: list[int] = []  # bound of the bucket that opened each container
    rooms: list[tuple[int, int]] = []  # room left and container, of those with any
    at = np.searchsorted(np.asarray(bounds, np.int64), lengths)
    for k in range(len(bounds) - 1, -1, -1):
        own = np.flatnonzero(at == k)
        own = own[np.argsort(lengths[own], kind="stable")]
        size, index = lengths[own].tolist(), own.tolist()
        left: list[tuple[int, int]] = []
        for room, c in sorted(rooms, reverse=True):
            while size and (i := bisect.bisect_right(size, room) - 1) >= 0:
                container[index[i]], room = c, room - size[i]
                del size[i], index[i]
            if room:
                left.append((room, c))
        rooms, room = left, 0
        for n, i in zip(reversed(size), reversed(index), strict=True):
            if n > room:
                if room:
                    rooms.append((room, len(opened) - 1))
                opened.append(bounds[k])
                room = capacity
            container[i], room = len(opened) - 1, room - n
        if room:
            rooms.append((room, len(opened) - 1))
    if len(lengths):
        bucket[:] = np.asarray(opened, np.int64)[container]
    return container, bucket


def pack(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    buckets: int = BUCKETS,
    tokenizer_path: str = TOKENIZER,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """The container of every piece: ``doc_id, piece, token_start, n_tokens, bucket, container_id``.

    Only texts of more than ``capacity`` tokens are cut, into full pieces and one rest. ``bucket`` is the
    upper bound of the bucket that opened the container. Null texts and texts without tokens have no
    piece; repeated rows are packed each for themselves.
    """
    sizes = checkpoint(token_counts(documents, doc_id, text, tokenizer_path).where("n_tokens > 0"))
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_tokens") - 1) / capacity)))
    start = F.col("piece") * capacity
    pieces = sizes.select("doc_id", "n_tokens", number.alias("piece")).select(
        "doc_id", "piece", start.alias("token_start"), F.least(F.lit(capacity), F.col("n_tokens") - start).cast("bigint").alias("n_tokens")
    )
    histogram = {r[0]: r[1] for r in pieces.groupBy("n_tokens").count().collect()}  # at most capacity rows
    bounds = bucket_bounds(histogram, buckets)
    groups = max(math.ceil(sum(histogram.values()) / group_pieces), 1)

    def form(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        container, bucket = fill(own["n_tokens"].to_numpy(), bounds, capacity)
        return own.assign(bucket=bucket, container_id=own["g"].to_numpy(np.int64) * (1 << 32) + container).drop(columns="g")

    grouped = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", F.lit(17)), F.lit(groups)))
    return grouped.groupBy("g").applyInPandas(
        form, "doc_id bigint, piece bigint, token_start bigint, n_tokens bigint, bucket bigint, container_id bigint"
    )


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers, pieces, tokens and the share of unused space by bucket."""
    containers = packed.groupBy("container_id").agg(
        F.max("bucket").alias("bucket"), F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces")
    )
    return containers.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_containers"), F.sum("pieces").alias("n_pieces"), F.sum("tokens").alias("n_tokens"),
        (1 - F.sum("tokens") / (F.count(F.lit(1)) * capacity)).alias("unused_share"),
    )
