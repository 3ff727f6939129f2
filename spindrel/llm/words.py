"""Words of a text, as the problems on texts define them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import xxhash

# Characters without width, and the soft hyphen.
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u180e\u00ad"
WORD = re.compile(r"[^\W_]+")
SLICE = 1 << 20


def clean(text: str) -> str:
    """Without invisible characters, then in NFKC."""
    if text.isascii():
        return text
    for c in INVISIBLE:
        if c in text:
            text = text.replace(c, "")
    return text if unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Consecutive parts of a long text, cut at the next end of a line or else at white space, so that no word is cut."""
    at, n = 0, len(text)
    space, line = re.compile(r"\s"), re.compile(r"\n")
    while at < n:
        end = n
        if n - at > size and (m := line.search(text, at + size, at + size + size // 8) or space.search(text, at + size)):
            end = m.end()
        yield text[at:end]
        at = end


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, in lower case."""
    return [w for part in slices(text or "") for w in _words(part)]


def _words(part: str) -> list[str]:
    part = clean(part)
    low = part.lower()
    # A few letters lower to a letter and a mark, which would end the run.
    return WORD.findall(low) if len(low) == len(part) else [w.lower() for w in WORD.findall(part)]


_ASCII = bytes(b if chr(b).isalnum() and b < 128 else 32 for b in range(256))


def word_bytes(part: str) -> list[bytes]:
    """The words in UTF-8; texts in ASCII need no pattern."""
    if part.isascii():
        return part.lower().encode().translate(_ASCII).split()
    return [w.encode("utf-8", "surrogatepass") for w in _words(part)]


class WordHash(dict):
    """64-bit hashes of words in UTF-8, remembered up to a bound."""

    most = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))

    def array(self, text: str | None) -> np.ndarray:
        parts = [self.of(word_bytes(p)) for p in slices(text or "")]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)
