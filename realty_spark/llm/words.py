"""Words of whole texts as 64-bit hashes, and their shingles, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 200_000  # bound of the word cache; it is emptied when full
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(31)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def forget() -> None:
    _hashes.clear()


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ of a text, as UTF-8; ``lower`` maps A-Z alone."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _MIX
    return h ^ (h >> np.uint64(29))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive words, in text order; of all words if there are fewer than k; none without words."""
    n = len(h)
    if not n:
        return h
    k = min(k, n)
    out = mix(h[:n - k + 1] * _MUL)
    for j in range(1, k):
        out = mix((out + h[j:n - k + 1 + j]) * _MUL)
    return out


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of a lower-cased text's k-word shingles."""
    return np.unique(grams(hashes(split(text, lower=True)), k))
