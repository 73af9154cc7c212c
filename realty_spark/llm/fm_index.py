"""A compressed full-text index over word sequences: Burrows-Wheeler transform, wavelet matrix, backward search, matching statistics."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: 64-bit words and a 32-bit count before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.uint32)  # a shard has less than 2^32 words

    def ones(self, i: np.ndarray) -> np.ndarray:
        """The number of ones before each position."""
        w = i >> 6
        below = self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[w].astype(np.int64) + np.bitwise_count(below)

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.before.nbytes


class WaveletMatrix:
    """Rank of any symbol in a sequence, over one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            b = (symbols >> level) & 1
            self.bits.append(Bits(b.astype(np.uint8)))
            self.zeros.append(int(len(b) - b.sum()))
            symbols = np.concatenate([symbols[b == 0], symbols[b == 1]])
        self.first = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(range(self.levels - 1, -1, -1), self.bits, self.zeros):
            ones = bits.ones(i)
            i = np.where((c >> level) & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c[j] occurs before position i[j]."""
        return self._down(c, i) - self.first[c]


def smallest(n: int) -> type:
    """The narrowest unsigned type that holds 0 to n."""
    return np.uint16 if n < 1 << 16 else np.uint32 if n < 1 << 32 else np.uint64


class FMIndex:
    """Index of word sequences, each ended by the separator 0, for patterns of at most ``depth`` words.

    What it keeps: the Burrows-Wheeler transform in a wavelet matrix, where
    each symbol's rows begin, the document of each row as a narrow number, and
    a bit per row that tells whether its suffix differs from the row before
    within ``depth - 1`` words, which shortens a match by its last word.
    Suffixes are sorted by their first ``depth`` words or a few more, which is
    all that patterns of that length can tell; the order itself is not kept.
    """

    def __init__(self, text: np.ndarray, owner: np.ndarray, sigma: int, depth: int):
        n = len(text)
        rank, h = text.astype(np.int64), 1
        ranks = {1: rank.astype(np.uint32)}
        order = np.argsort(rank, kind="stable")
        while h < depth:  # prefix doubling up to the pattern's length
            after = np.zeros(n, dtype=np.int64)
            after[:n - h] = rank[h:] + 1
            key = rank * (n + sigma + 1) + after
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            h *= 2
            ranks[h] = rank.astype(np.uint32)
        self.size, self.depth = n, depth
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        counts = np.bincount(text, minlength=sigma)
        self.starts = (np.cumsum(counts) - counts).astype(np.uint32)
        self.documents = owner[order].astype(smallest(int(owner.max(initial=0))))
        self.apart = Bits(self._apart(ranks, order, depth - 1, n))

    @staticmethod
    def _apart(ranks: dict[int, np.ndarray], order: np.ndarray, depth: int, n: int) -> np.ndarray:
        """For each row whether its suffix differs from the row before in their first ``depth`` words."""
        same = np.ones(n - 1, dtype=bool)
        a, b, at = order[:-1], order[1:], 0
        while at < depth:
            h = max(p for p in ranks if p <= depth - at)
            inside = (a + at < n) & (b + at < n)
            same &= inside & (ranks[h][np.minimum(a + at, n - 1)] == ranks[h][np.minimum(b + at, n - 1)])
            at += h
        return np.concatenate([[1], (~same).astype(np.uint8)])

    @property
    def nbytes(self) -> int:
        return sum(b.nbytes for b in self.bwt.bits) + self.bwt.first.nbytes + self.starts.nbytes + self.documents.nbytes + self.apart.nbytes

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the rows of c[j] followed by what rows lo[j] to hi[j] begin with."""
        return self.starts[c] + self.bwt.rank(c, lo), self.starts[c] + self.bwt.rank(c, hi)

    def shortened(self, lo: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that agree with row lo[j] in one word less than ``depth``; ends: ``group_ends()``."""
        group = self.apart.ones(lo + 1) - 1
        return ends[group], ends[group + 1]

    def group_ends(self) -> np.ndarray:
        """Where the runs of rows that agree in ``depth - 1`` words begin, and the number of rows, read off the bits."""
        bits = np.unpackbits(self.apart.words.view(np.uint8), bitorder="little")[:self.size]
        return np.append(np.flatnonzero(bits), self.size)

    def matches(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, lo, hi): the rows of the window of ``depth`` words at each place of the streamed sequences; lo = hi without one.

        All sequences are streamed at once, from their last word to their
        first, a word that the index lacks being negative.  The matching
        statistic, cut at ``depth`` words, is kept with its rows: a full match
        is shortened by its last word before the next word extends it to the
        left, and a step that leaves no row starts anew.
        """
        sizes = np.array([len(s) for s in sequences], dtype=np.int64)
        offsets = np.cumsum(sizes) - sizes
        text = np.concatenate(sequences) if len(sequences) else np.zeros(0, dtype=np.int64)
        found_lo, found_hi = np.zeros(len(text), dtype=np.uint32), np.zeros(len(text), dtype=np.uint32)
        order = np.argsort(-sizes, kind="stable")
        at, left, ends = offsets[order], sizes[order], self.group_ends()
        lo, hi = np.zeros(len(order), dtype=np.int64), np.full(len(order), self.size, dtype=np.int64)
        length = np.zeros(len(order), dtype=np.int64)
        for step in range(int(left[0]) if len(left) else 0):
            alive = int(np.searchsorted(-left, -step, side="left"))  # sequences with more than `step` words
            full = np.flatnonzero(length[:alive] == self.depth)
            if len(full):
                lo[full], hi[full] = self.shortened(lo[full], ends)
                length[full] -= 1
            position = at[:alive] + left[:alive] - 1 - step
            symbol = text[position]
            known = symbol >= 0
            a, b = self.extend(np.maximum(symbol, 0), lo[:alive], hi[:alive])
            some = known & (a < b)
            # what lacks the longer match may still have a shorter one; below a full window none is asked for
            lost = np.flatnonzero(~some)
            lo[:alive], hi[:alive], length[:alive] = np.where(some, a, 0), np.where(some, b, self.size), np.where(some, length[:alive] + 1, 0)
            if len(lost):
                self._anew(lost, text, position, at, left, lo, hi, length)
            whole = length[:alive] == self.depth
            found_lo[position[whole]], found_hi[position[whole]] = lo[:alive][whole], hi[:alive][whole]
        return offsets, found_lo, found_hi

    def _anew(self, lost: np.ndarray, text: np.ndarray, position: np.ndarray, at: np.ndarray, left: np.ndarray,
              lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> None:
        """The longest match that begins at a lost place: its words are searched from the right end that still matches, by halving."""
        for j in lost.tolist():
            begin, end = int(position[j]), int(at[j] + left[j])
            few, many = 0, min(self.depth - 1, end - begin)
            best = (0, self.size)
            while few < many:  # a prefix of a match matches too
                middle = (few + many + 1) // 2
                a, b = np.array([0]), np.array([self.size])
                for c in text[begin:begin + middle][::-1]:
                    a, b = self.extend(np.array([max(c, 0)]), a, b) if c >= 0 else (a, a)
                    if a[0] >= b[0]:
                        break
                if a[0] < b[0]:
                    few, best = middle, (int(a[0]), int(b[0]))
                else:
                    many = middle - 1
            lo[j], hi[j], length[j] = best[0], best[1], few


def least_document(sequences: list[list[bytes]], docs: list[int], window: int) -> list[np.ndarray]:
    """For each window start of each sequence, the least document among all sequences that hold this window.

    The sequences are indexed and streamed through the index; the rows of a
    window give its documents.
    """
    numbers: dict[bytes, int] = {}
    ids = [np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in s), dtype=np.int64, count=len(s)) for s in sequences]
    sizes = np.array([len(s) for s in ids], dtype=np.int64)
    known, number = np.unique(np.array(docs, dtype=np.int64), return_inverse=True)  # in ascending order
    index = FMIndex(np.concatenate([np.append(s, 0) for s in ids]), np.repeat(number, sizes + 1), len(numbers) + 1, window)
    offsets, lo, hi = index.matches(ids)
    rows, which = np.unique(lo[lo < hi].astype(np.int64) << 32 | hi[lo < hi], return_inverse=True)
    ends = np.stack([rows >> 32, rows & 0xFFFFFFFF], axis=1)  # equal or disjoint, ascending
    least = np.minimum.reduceat(np.append(index.documents, index.documents[-1:]), ends.ravel())[::2] if len(rows) else np.zeros(0, dtype=np.int64)
    out = np.zeros(len(lo), dtype=np.int64)
    out[lo < hi] = known[least[which].astype(np.int64)] if len(rows) else 0
    return [out[b:b + max(0, n - window + 1)] for b, n in zip(offsets.tolist(), sizes.tolist())]
