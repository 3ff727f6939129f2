"""Per-document text quality statistics, and which documents are not running prose.

Layout is measured first: delimiters that stand in the same number and kind on line after line or fill a line
(vertical alignment), marks of lists, indentation that returns with a period, and lengths of lines that follow
each other (autocorrelation). Together with the ratios of symbols, digits and punctuation they set what a stretch of
words has to show in order to be prose.

It can show it in two ways, in a window of some twenty words. Function words of the list given recur in prose at a
certain rate with some variety, where lists, tables, logs and menus lack them, repeat one or two of them, or
consist of them alone; where the layout speaks for a table or list, a higher rate is asked for. Or, in whatever language, the
words have the form of sentences: letters with vowels among them, words of all lengths, short ones between long ones, hardly
repeated, in lines of several words with few digits, commas or other symbols, and ends of sentences. This way is open only
where no layout speaks against it. Both are measured per stretch, so that a text of mixed content gets the share of
its characters that belong to prose, with borders moved to where the evidence turns.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.llm.words import SLICE, clean, slices

_TOP = 0x32400  # no letters or white space above
_codes = [chr(c) for c in range(_TOP)]
_ALNUM = np.array([c.isalnum() for c in _codes])
_WHITE = np.array([c.isspace() for c in _codes])
_LINE = np.array([len(f"a{c}a".splitlines()) > 1 for c in _codes])
del _codes


def _table(chars: str) -> np.ndarray:
    out = np.zeros(_TOP, bool)
    out[[ord(c) for c in chars]] = True
    return out


_HAN = np.zeros(_TOP, bool)
_HAN[0x3400:0xA000] = _HAN[0x20000:_TOP] = True
_ENDING = _table(".!?。！？…:;\"'”’»)")  # a line may end in these
_STOP = _table(".!?。！？")  # a sentence ends in these, before white space or one of the next
_AFTER = _table("<\"'”»)]。！？") | _WHITE
_DELIMITER = _table("|;\t=»：")
_BULLET = _table("-*•+")
_COMMA = _table(",，、")
_INNER = _table("'’-‐,.!?:;\"“”„()«»") | _WHITE  # between words of a sentence; all else is a symbol

# Vowels of the Latin, Cyrillic and Greek alphabets, without their marks. Letters of other scripts need none.
_VOWELS = set("aeiouyаеёиоуыэюяіїєαεηιουω")
_VOWEL = np.ones(_TOP, bool)
_VOWEL[:0x530] = [unicodedata.normalize("NFD", chr(c).lower())[0] in _VOWELS or not chr(c).isalpha() for c in range(0x530)]
_VOWEL[0x1E00:0x2000] = [unicodedata.normalize("NFD", chr(c).lower())[0] in _VOWELS for c in range(0x1E00, 0x2000)]
_DIGIT = np.array([chr(c).isdigit() for c in range(_TOP)])
_PRIME = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses

HALF = 10  # words on either side of a word that its rate is taken over
RATE_LOW, RATE_HIGH = 0.125, 0.72
RATE_STRUCTURED = 0.22
VARIETY = 3
#: What the form of sentences asks of a window: shares of its words.
WORDLIKE, SHORT_LOW, SHORT_HIGH, LONG_LOW, DISTINCT = 0.65, 0.08, 0.7, 0.3, 0.7
DIGITS, COMMAS, SYMBOLS, LINES, STOPS = 0.3, 0.25, 0.15, 0.25, 0.1
AUTO, LAYOUT_LINES = 0.6, 6  # autocorrelation of a layout, and lines from which on it tells
GAP = 12  # characters between two words of prose that still belong to it
SNAP = 14
_LLR = (1.9, -0.42)  # evidence for prose of a function word and of any other word
_SOUP = -0.6  # ... and of a word among nothing but function words
_BONUS = (2.0, 5.0)  # for a border at a new line, and at the end of a sentence or paragraph
_RUN = 5  # ideographs in a row that make a clause, as words of lists are shorter

_COLUMNS = (
    "n_chars bigint, n_words bigint, mean_word_length double, symbol_ratio double, digit_ratio double, "
    "n_lines bigint, line_end_punctuation double, common_word_share double, delimiter_alignment double, "
    "list_line_share double, indent_period bigint, line_autocorrelation double, prose_share double"
)


def autocorrelation(x: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Correlation of each document's series with itself one later; 1 for a constant, 0 for fewer than 3 values."""
    n = np.bincount(doc, minlength=docs)
    y = x - (np.bincount(doc, x, docs) / np.maximum(n, 1))[doc]
    var = np.bincount(doc, y * y, docs)
    pair = doc[1:] == doc[:-1]
    cov = np.bincount(doc[1:][pair], (y[1:] * y[:-1])[pair], docs)
    out = np.divide(cov, var, out=np.ones(docs), where=var > 1e-12)
    return np.where(n < 3, 0.0, out)


_LAGS = range(2, 9)
_COUNTS = ("chars", "words", "letters", "digits", "lines", "ended", "common", "aligned", "listed", "auto", "prose", *(f"indent{i}" for i in range(1 + 2 * len(_LAGS))))


def indent_counts(indents: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Rows of each document's changes of indentation and, for each lag, pairs of lines so far apart and equal ones among them."""
    out = np.zeros((1 + 2 * len(_LAGS), docs), np.int64)
    if len(doc):
        out[0] = np.bincount(doc[1:], (doc[1:] == doc[:-1]) & (indents[1:] != indents[:-1]), docs)
    for k, lag in enumerate(x for x in _LAGS if x < len(doc)):
        pair = doc[lag:] == doc[:-lag]
        out[1 + 2 * k] = np.bincount(doc[lag:], pair, docs)
        out[2 + 2 * k] = np.bincount(doc[lag:], pair & (indents[lag:] == indents[:-lag]), docs)
    return out


def indent_period(counts: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """The least period, from 2 lines on, with which a document's indentation returns; 0 if it doesn't or never changes."""
    out = np.zeros(len(lines), np.int64)
    for k, lag in reversed(list(enumerate(_LAGS))):
        pairs, again = counts[1 + 2 * k], counts[2 + 2 * k]
        out[(counts[0] > 0) & (lines >= max(6, 2 * lag)) & (pairs > 0) & (again >= 0.9 * pairs)] = lag
    return out


class Layout:
    """Lines of the documents in a chunk and which of them look like rows of a table or items of a list."""

    def __init__(self, codes: np.ndarray, white: np.ndarray, doc_start: np.ndarray) -> None:
        n = len(codes)
        stop = np.flatnonzero(_LINE[codes])
        fold = codes[stop] == 13  # a line feed after a carriage return ends the same line
        if fold.any():
            stop = stop[~(fold & (stop + 1 < n) & (codes[np.minimum(stop + 1, n - 1)] == 10))]
        self.start, self.end = np.concatenate([[0], stop + 1]), np.concatenate([stop, [n]])
        self.doc = np.searchsorted(doc_start, self.start, "right") - 1
        ink = np.flatnonzero(~white)
        i = np.searchsorted(ink, self.start)
        j = np.searchsorted(ink, self.end)
        self.blank = i >= j
        self.full = full = ~self.blank
        if len(ink):
            first, last = ink[np.minimum(i, len(ink) - 1)], ink[np.maximum(j - 1, 0)]
        else:
            first = last = np.zeros(len(self.start), np.int64)
        self.indents, self.widths = (first - self.start)[full], (last - self.start + 1)[full]
        self.ended = full & _ENDING[codes[last]]

        c0, c1, c2, c3 = (codes[np.minimum(first + k, n - 1)] for k in range(4))
        digit = lambda c: (c >= 48) & (c <= 57)
        mark = lambda c: (c == 46) | (c == 41)
        number = digit(c0) & (mark(c1) | digit(c1) & (mark(c2) | digit(c2) & mark(c3)))
        self.listed = full & (_BULLET[c0] & _WHITE[c1] | number | (c0 == 91) & digit(c1))

        after = np.concatenate([codes[1:], [32]])
        where = np.flatnonzero(_DELIMITER[codes] | (codes == 58) & _WHITE[after] | (codes == 45) & (after == 62))
        line = np.searchsorted(self.end, where, "left")
        count = np.bincount(line, minlength=len(self.start))
        kinds = np.bincount(line, codes[where].astype(float), minlength=len(self.start))
        same = np.zeros(len(self.start), bool)
        pair = (count[1:] == count[:-1]) & (kinds[1:] == kinds[:-1]) & (count[1:] > 0) & (self.doc[1:] == self.doc[:-1])
        same[1:] |= pair
        same[:-1] |= pair
        self.aligned = same & full
        many = (count >= 4) & (count * 25 >= self.end - self.start)
        self.structured = full & (same | many | self.listed & (self.end - self.start < 60))


def _turn(evidence: np.ndarray, at: int, bonus: np.ndarray, rising: bool, low: int, high: int) -> int:
    """The border near ``at`` where the running evidence is lowest (prose begins) or highest (prose ends)."""
    lo, hi = max(at - SNAP, low), min(at + SNAP, high)
    value = bonus[lo : hi + 1] - evidence[lo : hi + 1] if rising else bonus[lo : hi + 1] + evidence[lo : hi + 1]
    return lo + int(value.argmax())


def _window_or(bits: np.ndarray, half: int) -> np.ndarray:
    """Bitwise or over ``half`` entries on either side, for all entries that have so many."""
    width, have = 2 * half + 1, 1
    while have < width:
        step = min(have, width - have)
        bits = bits[:-step] | bits[step:]
        have += step
    return bits


def prose_mask(ids: np.ndarray, structured: np.ndarray, bonus: np.ndarray, doc: np.ndarray, form: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Which words belong to running prose.

    ``ids``: number of the function word (-1: none); ``structured``: does the layout of its line or document speak for a table
    or list; ``bonus``: how well a border goes before each word, and after the last; ``doc``: number of its document;
    ``form``: of each word, whether it looks like a word, is short or long, has digits, and what symbols, commas, ends of
    lines and of sentences follow it, and a hash.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, bool)
    common = ids >= 0
    at = np.arange(n)
    low, high = np.searchsorted(doc, doc, "left"), np.searchsorted(doc, doc, "right")
    lo, hi = np.maximum(at - HALF, low), np.minimum(at + HALF + 1, high)
    width = hi - lo
    total = np.concatenate([[0], np.cumsum(common)])
    rate = (total[hi] - total[lo]) / width
    place = at + HALF * (1 + doc - doc[0])  # room between documents, so that no window sees two
    bits = np.zeros(place[-1] + HALF + 1, np.uint64)
    bits[place] = np.where(common, np.uint64(1) << (ids % 61).astype(np.uint64), np.uint64(0))
    variety = np.bitwise_count(_window_or(bits, HALF)[place - HALF])
    s = np.concatenate([[0], np.cumsum(structured)])
    asked = np.where((s[hi] - s[lo]) * 2 > width, RATE_STRUCTURED, RATE_LOW)
    mask = (rate >= asked) & (rate <= RATE_HIGH) & (variety >= np.where(high - low < 14, 2, VARIETY))
    if form is not None:
        share = lambda x: (lambda c: (c[hi] - c[lo]) / width)(np.concatenate([[0], np.cumsum(x)]))
        bits[:] = 0
        bits[place] = np.uint64(1) << (form["hash"] >> np.uint64(58))
        distinct = np.bitwise_count(_window_or(bits, HALF)[place - HALF])
        expected = 64 * (1 - (1 - 1 / 64) ** width)  # of as many words that all differ
        short = share(form["short"])
        sentence = (
            (share(form["word"]) >= WORDLIKE) & ((short >= SHORT_LOW) | (share(form["stop"]) >= STOPS)) & (short <= SHORT_HIGH) & (share(form["long"]) >= LONG_LOW)
            & (distinct >= DISTINCT * expected) & (share(form["digit"]) <= DIGITS) & (share(form["comma"]) <= COMMAS)
            & (share(form["symbol"]) <= SYMBOLS) & (share(form["line"]) <= LINES) & ((share(form["stop"]) > 0) | (rate >= RATE_LOW / 2))
            & (share(structured) == 0) & (rate <= RATE_HIGH) & (width >= 6)
        )
        mask |= sentence
    near_lo, near_hi = np.maximum(at - 3, low), np.minimum(at + 4, high)
    soup = total[near_hi] - total[near_lo] > 0.8 * (near_hi - near_lo)
    points = np.where(soup, _SOUP, np.where(common, *_LLR))
    if form is not None:
        points = np.where(sentence & ~soup, np.where(form["word"], 0.5, -0.5), points)
    evidence = np.concatenate([[0], np.cumsum(points)])
    inside = np.zeros(n + 1, bool)
    inside[1:-1] = mask[1:] & mask[:-1] & (doc[1:] == doc[:-1])
    begins, ends = np.flatnonzero(mask & ~inside[:-1]), np.flatnonzero(mask & ~inside[1:]) + 1
    out = np.zeros(n, bool)
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        bounds = (int(low[a]), int(high[a]))
        first, end = _turn(evidence, a, bonus, True, *bounds), _turn(evidence, b, bonus, False, *bounds)
        if end > first:
            out[first:end] = True
    return out


class Statistics:
    """Statistics of texts, given the function words."""

    def __init__(self, common: list[str]) -> None:
        known = sorted({w for w in common if w and all(c.isalnum() for c in w)})
        self.longest = max(map(len, known), default=0)
        self._grow(4 * SLICE)
        keys = [self._keys(np.array([*map(ord, w)], np.uint32), np.array([0]), np.array([len(w)]))[0] for w in known]
        self.keys = np.array(sorted(keys), np.uint64)

    def _grow(self, n: int) -> None:
        powers = lambda x: np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, np.uint64))])
        self.powers, self.inverse = powers(_PRIME), powers(pow(_PRIME, -1, 1 << 64))

    def _keys(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A polynomial hash of each word, the same wherever it stands."""
        n = len(codes)
        if n >= len(self.powers):
            self._grow(2 * n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(codes.astype(np.uint64) * self.powers[:n])])
        return (sums[end] - sums[start]) * self.inverse[start]

    def _words(self, codes: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and function word number (-1: none) of the words; ideographs are words of their own."""
        alnum, han = _ALNUM[codes], _HAN[codes]
        before, behind = np.concatenate([[False], alnum[:-1]]), np.concatenate([[False], han[:-1]])
        start = np.flatnonzero(alnum & (~before | han | behind))
        end = np.flatnonzero(np.concatenate([before & (~alnum | behind | han), alnum[-1:]]))
        ids = np.full(len(start), -1, np.int64)
        short = np.flatnonzero(end - start <= self.longest)
        if len(short) and len(self.keys):
            keys = self._keys(low, start[short], end[short])
            i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[i] == keys
            # A letter alone is a word only between spaces, not in an initial or in n/a.
            a, b = start[short], end[short]
            white = np.concatenate([[True], _WHITE[codes], [True]])
            hit &= (b - a > 1) | han[a] | white[a] & white[b + 1]
            ids[short[hit]] = i[hit]
        if han.any():
            edge = np.diff(np.concatenate([[0], han.astype(np.int8), [0]]))
            a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            i, j = np.searchsorted(start, a), np.searchsorted(start, b)
            total = np.concatenate([[0], np.cumsum(ids >= 0)])
            clause = (b - a >= _RUN) & (total[j] - total[i] <= 0.6 * (j - i))
            for p, q in zip(i[clause].tolist(), j[clause].tolist(), strict=True):
                third = ids[p:q:3]
                third[third < 0] = 1000 + np.flatnonzero(third < 0) % 7
        return start, end, ids

    def _form(self, codes: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray, line: np.ndarray, doc: np.ndarray, stops: np.ndarray) -> dict[str, np.ndarray]:
        """What each word looks like and what stands between it and the next."""
        upto = lambda x: np.concatenate([[0], np.cumsum(x)])
        size = end - start
        vowels, digits, han = upto(_VOWEL[codes]), upto(_DIGIT[codes]), _HAN[codes[start]]
        digit = digits[end] - digits[start] > 0
        after = np.concatenate([start[1:], [len(codes)]])
        symbols, commas, solid = upto(~(_INNER[codes] | _ALNUM[codes])), upto(_COMMA[codes]), upto(~_WHITE[codes])
        ends = stops[(stops > 0) & ~(_WHITE | _STOP)[codes[np.maximum(stops - 1, 0)]]]  # no rows of dots
        stop = np.zeros(len(start), bool)
        stop[np.minimum(np.maximum(np.searchsorted(start, ends) - 1, 0), len(start) - 1)] = True
        last = np.concatenate([doc[1:] != doc[:-1], [True]])
        return {
            "word": ~digit & ~han & ((vowels[end] - vowels[start] > 0) | (size == 1)) & (size <= 30), "short": size <= 3, "long": size >= 5,
            "digit": digit, "symbol": (symbols[after] - symbols[end] > 0) | (solid[after] - solid[end] > 4), "comma": commas[after] - commas[end] > 0,
            "line": np.concatenate([line[1:] != line[:-1], [False]]) & ~last, "stop": stop, "hash": self._keys(low, start, end) * np.uint64(_PRIME),
        }

    def chunk(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Counts of each of some texts, which are measured side by side."""
        parts = [clean(t) for t in texts]
        lows = [x if len(x) == len(p) else p for p in parts for x in [p.lower()]]
        raw = lambda x: np.minimum(np.frombuffer("\n".join(x).encode("utf-32-le", "surrogatepass"), np.uint32), _TOP - 1)
        codes, low = raw(parts), raw(lows)
        docs = len(parts)
        doc_start = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
        if not len(codes):
            codes = low = np.array([32], np.uint32)
        white = _WHITE[codes]
        lay = Layout(codes, white, doc_start)
        start, end, ids = self._words(codes, low)
        n = len(ids)
        doc = np.searchsorted(doc_start, start, "right") - 1
        solid = np.concatenate([[0], np.cumsum(~white)])
        per = lambda d, w=None: np.bincount(d, w, docs)
        prose = np.zeros(docs)
        full_doc = lay.doc[lay.full]
        lines = np.bincount(full_doc, minlength=docs)
        indents = indent_counts(lay.indents, full_doc, docs)
        auto = autocorrelation(lay.widths.astype(float), full_doc, docs)
        layout = (indent_period(indents, lines) > 0) | (auto > AUTO) | (np.bincount(full_doc, lay.aligned[lay.full], docs) > 0.5 * lines)
        layout &= lines >= LAYOUT_LINES
        if n:
            line = np.searchsorted(lay.end, start, "left")
            bonus = np.zeros(n + 1)
            bonus[1:-1][line[1:] != line[:-1]] = _BONUS[0]
            ends = np.flatnonzero(_STOP[codes] & np.concatenate([_AFTER[codes[1:]] | (codes[:-1] > 0x3000), [True]]))
            bonus[np.searchsorted(start, ends)] = _BONUS[1]
            bonus[np.searchsorted(start, lay.start[lay.blank])] = _BONUS[1]
            bonus[1:-1][doc[1:] != doc[:-1]] = _BONUS[1]
            bonus[[0, -1]] = _BONUS[1]
            laid = lay.structured | layout[lay.doc]
            mask = prose_mask(ids, laid[line], bonus, doc, self._form(codes, low, start, end, line, doc, ends))
            gap = solid[np.concatenate([start[1:], [len(codes)]])] - solid[end]
            both = np.zeros(n, bool)
            both[:-1] = mask[:-1] & mask[1:] & (doc[1:] == doc[:-1])
            joined = np.where(both, np.where(gap <= GAP, gap, 0), np.minimum(gap, 1))
            prose = per(doc[mask], (solid[end] - solid[start] + joined)[mask])
        digits = np.concatenate([[0], np.cumsum((codes >= 48) & (codes <= 57))])
        bounds = np.concatenate([doc_start, [len(codes)]])
        chars = solid[bounds[1:]] - solid[bounds[:-1]]
        return {
            "chars": chars, "words": per(doc), "letters": per(doc, end - start), "digits": digits[bounds[1:]] - digits[bounds[:-1]],
            "lines": per(lay.doc[lay.full]), "ended": per(lay.doc[lay.ended]), "common": per(doc[(ids >= 0) & (ids < 1000)]),
            "aligned": per(lay.doc[lay.aligned]), "listed": per(lay.doc[lay.listed]),
            "auto": auto, "prose": np.minimum(prose, chars), **{f"indent{i}": row for i, row in enumerate(indents)},
        }

    def of(self, texts: list[str]) -> pd.DataFrame:
        """Statistics of texts; those longer than a slice are measured slice by slice and added up."""
        owner, chunks, now, size = [], [], [], 0
        for k, t in enumerate(texts):
            for part in slices(t) if len(t) > SLICE else [t]:
                owner.append(k)
                now.append(part)
                size += len(part)
                if size > SLICE // 2:
                    chunks.append(self.chunk(now))
                    now, size = [], 0
        if now:
            chunks.append(self.chunk(now))
        parts = pd.DataFrame({k: np.concatenate([c[k] for c in chunks]) if chunks else [] for k in _COUNTS})
        parts["auto"] *= parts["lines"]
        t = parts.groupby(np.asarray(owner, np.int64)).sum()
        period = indent_period(np.stack([t[f"indent{i}"].to_numpy() for i in range(1 + 2 * len(_LAGS))]), t["lines"].to_numpy())
        some = t["chars"] > 0
        w, n, c = t["words"].clip(lower=1), t["lines"].clip(lower=1), t["chars"].clip(lower=1)
        out = pd.DataFrame({
            "n_chars": t["chars"], "n_words": t["words"], "mean_word_length": t["letters"] / w, "symbol_ratio": (t["chars"] - t["letters"]) / c,
            "digit_ratio": t["digits"] / c, "n_lines": t["lines"], "line_end_punctuation": t["ended"] / n, "common_word_share": t["common"] / w,
            "delimiter_alignment": t["aligned"] / n, "list_line_share": t["listed"] / n, "indent_period": period,
            "line_autocorrelation": t["auto"] / n, "prose_share": t["prose"] / c,
        })
        ratios = [x for x in out.columns if not x.startswith("n_") and x != "indent_period"]
        out[ratios] = out[ratios].where(some)
        whole = [x for x in out.columns if x not in ratios]
        out[whole] = out[whole].astype("int64")
        return out


def text_statistics(documents: DataFrame, common_words: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics of every document, one row for each.

    ``common_words`` has the column ``word``; it is a fixed list of some hundred words, and refused if it has
    more than 100,000. Null and blank texts have no words and null ratios. Characters are counted without
    white space and after compatibility composition. Texts above a million characters are measured in parts
    of that size, cut at ends of lines if there are any, and the counts of the parts added up. The columns are those of ``_COLUMNS``.
    """
    known = [r[0] for r in common_words.select(F.lower("word")).where("word is not null").distinct().limit(100_001).collect()]
    if len(known) > 100_000:
        raise ValueError("the list of common words is not a short one")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        statistics = Statistics(known)
        for b in batches:
            out = statistics.of([t or "" for t in b["t"].tolist()])
            out.insert(0, "doc_id", b["d"].to_numpy())
            yield out

    rows = documents.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).cast("string").alias("t"))
    return rows.mapInPandas(measure, "doc_id bigint, " + _COLUMNS)
