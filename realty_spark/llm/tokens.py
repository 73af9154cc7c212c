"""Whole-text encoding with a public tokenizer file, through a bounded table of space-delimited chunks.

A byte-level BPE splits text into pieces before merging, and a single space
between two non-space characters always starts a new piece.  So the ids of a
text are the ids of its space-delimited chunks in order, and a chunk that was
met before need not be merged again.  A chunk gets a number when it is first
met; the chunks that a group of texts brings are encoded together, by the
tokenizer, in one call, and the group's ids are gathered by chunk numbers.
"""

from __future__ import annotations

import json
import os
import re
import string
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain, compress
from operator import attrgetter

import numpy as np

END_ID = 0
END = END_ID.to_bytes(4, "little")
BLOCK = 50_000  # chunks of a long text taken at once
GROUP = 200_000  # chunks of short texts whose ids are gathered together
CACHE_CHUNKS = 800_000  # bound of the table; between groups, when it is full, chunks met once leave it
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]  # white space other than the space and the line break
_TAIL = string.punctuation
_LETTERS_END = "\u0250"  # all letters below are letters in every version of Unicode
_ID = attrgetter("id")
_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str, cache_chunks: int | None = None) -> "Encoder":
    """The encoder of this Python worker for a tokenizer file; its table stays from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].bound = cache_chunks or CACHE_CHUNKS
    return _ENCODERS[path]


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)


def _alphabet(path: str) -> str | None:
    """The letters that stand for bytes 0 to 255, the line break for itself; None unless the pieces are words of letters with the space before and merges alone make their ids."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    pieces, model = said.get("pre_tokenizer") or {}, said["model"]
    if said.get("normalizer") or said.get("truncation") or pieces.get("type") != "ByteLevel" or pieces.get("add_prefix_space") or not pieces.get("use_regex", True):
        return None
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        return None
    hidden = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b >= 174)]  # the other bytes stand for themselves
    shown = {b: chr(256 + i) for i, b in enumerate(hidden)} | {ord("\n"): "\n"}
    return "".join(shown.get(b, chr(b)) for b in range(256))


class _Numbers(dict):
    """Numbers of chunks, given as they are first met; ``new`` holds those not yet encoded."""

    def __init__(self, shared: list[int]):
        self.shared, self.new = shared, []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = self.shared[0]
        self.shared[0] += 1
        self.new.append(chunk)
        return n


class Encoder:
    """Encodes texts with one tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        size = max(vocab.values()) + 1
        self.n_bytes = np.zeros(size, dtype=np.int64)
        self.ends_sentence = np.zeros(size, dtype=bool)
        for piece, i in vocab.items():
            self.n_bytes[i] = len(piece)  # one character stands for one byte
            self.ends_sentence[i] = piece[-1] in ".!?" or "Ċ" in piece  # Ċ stands for a line break
        self.alphabet, self.merged = _alphabet(path), self.tok.model.tokenize
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.bound = CACHE_CHUNKS
        self.tails: dict[str, int] = {}  # marks after a word, numbered
        self.tail_at, self.tail_size, self.tail_ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4")
        self._clear()

    def _clear(self) -> None:
        self.count = [0]
        self.inner = _Numbers(self.count)  # chunks after a space
        self.first = _Numbers(self.count)  # chunks at a text's beginning
        self.at, self.size = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)
        self.ids, self.used = np.zeros(1 << 16, dtype="<u4"), 0
        self.hits = np.zeros(0, dtype=np.int64)  # how often each chunk was met, halved whenever others went

    def _thin(self) -> None:
        """Only chunks met more than once stay in the table, and no more than half its bound."""
        numbers = np.fromiter(self.inner.values(), dtype=np.int64, count=len(self.inner))
        hits, most = self.hits[numbers], max(1, self.bound // 2)
        stays = hits > (np.partition(hits, -most)[-most] if np.count_nonzero(hits > 1) > most else 1)
        kept, numbers = list(compress(self.inner, stays.tolist())), numbers[stays]
        sizes = self.size[numbers]
        ids = self.ids[_spans(self.at[numbers], sizes)]
        self._clear()
        self.inner.update(zip(kept, range(len(kept))))
        self.count[0], self.hits = len(kept), (hits[stays] + 1) // 2
        self._put(np.arange(len(kept)), sizes, ids)

    def _plain(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _put(self, numbers: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Enter the ids of chunks, one after the other, under their numbers."""
        if len(self.at) < self.count[0]:
            more = max(self.count[0], 2 * len(self.at))
            self.at, self.size = np.resize(self.at, more), np.resize(self.size, more)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, max(self.used + len(ids), 2 * len(self.ids)))
        self.at[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _learn(self) -> None:
        """Encode the chunks met since the last call.  Letters and the marks after them are separate pieces: a word is merged once for all marks."""
        if self.first.new:
            got = [np.asarray(e.ids, dtype="<u4") for e in self.tok.encode_batch_fast(self.first.new, add_special_tokens=False)]
            self._put(np.array([self.first[p] for p in self.first.new]), np.array([len(g) for g in got]), np.concatenate(got))
            self.first.new = []
        if not self.inner.new:
            return
        marked = [(p, w) for p in self.inner.new if p[-1:] in _TAIL and (w := p.rstrip(_TAIL)).isalpha()]
        bare = self.inner.new
        if marked:
            apart = {p for p, _ in marked}
            bare = [p for p in bare if p not in apart]
            self.inner.new = []
            for _, w in marked:
                self.inner[w]  # a word without its marks may be new as well
            bare += self.inner.new
        self.inner.new = []
        self._encode(bare)
        if marked:
            self._learn_tails({p[len(w):] for p, w in marked})
            base = np.fromiter((self.inner[w] for _, w in marked), dtype=np.int64, count=len(marked))
            tail = np.fromiter((self.tails[p[len(w):]] for p, w in marked), dtype=np.int64, count=len(marked))
            first, then = self.size[base], self.tail_size[tail]
            begins = np.cumsum(first + then) - first - then
            ids = np.empty(int((first + then).sum()), dtype="<u4")
            ids[_spans(begins, first)] = self.ids[_spans(self.at[base], first)]
            ids[_spans(begins + first, then)] = self.tail_ids[_spans(self.tail_at[tail], then)]
            self._put(np.fromiter((self.inner[p] for p, _ in marked), dtype=np.int64, count=len(marked)), first + then, ids)

    def _learn_tails(self, tails: set[str]) -> None:
        for tail in sorted(tails.difference(self.tails)):
            ids = self._plain(tail)
            self.tails[tail] = len(self.tails)
            self.tail_at, self.tail_size = np.append(self.tail_at, len(self.tail_ids)), np.append(self.tail_size, len(ids))
            self.tail_ids = np.append(self.tail_ids, ids)

    def _encode(self, new: list[str]) -> None:
        """Encode chunks, each with its leading space: words of letters by the merges alone, the others as one text."""
        rest = new
        if self.alphabet:
            words, rest = [], []
            for p in new:
                (words if p.isalpha() and (p.isascii() or max(p) < _LETTERS_END) else rest).append(p)
            if words:
                pieces = charmap_decode((" " + "\n ".join(words)).encode(), "strict", self.alphabet)[0].split("\n")
                ids = np.fromiter(map(_ID, chain.from_iterable(map(self.merged, pieces))), dtype="<u4")
                self._cut(words, ids, np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
        if rest:
            ids = np.asarray(self.tok.encode_batch_fast([" " + " ".join(rest)], add_special_tokens=False)[0].ids, dtype="<u4")
            self._cut(rest, ids, np.fromiter(map(len, map(str.encode, rest)), dtype=np.int64, count=len(rest)) + 1)

    def _cut(self, new: list[str], ids: np.ndarray, n_bytes: np.ndarray) -> None:
        """Enter the ids of chunks, which follow each other, by the chunks' bytes."""
        numbers = np.fromiter(map(self.inner.__getitem__, new), dtype=np.int64, count=len(new))
        token_ends, chunk_ends = np.cumsum(self.n_bytes[ids]), np.cumsum(n_bytes)
        cuts = np.searchsorted(token_ends, chunk_ends, side="left") + 1
        if len(ids) and np.array_equal(token_ends[np.minimum(cuts, len(ids)) - 1], chunk_ends):
            self._put(numbers, np.diff(cuts, prepend=0), ids[:cuts[-1]])
            return
        got = [self._plain(" " + p) for p in new]  # a tokenizer that merges over spaces
        self._put(numbers, np.array([len(g) for g in got]), np.concatenate(got))

    def _parts(self, text: str) -> list[str]:
        """The text cut at each single space between two non-space characters."""
        if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or any(c in text for c in _RARE):
            return _BETWEEN.split(text)
        return text.split(" ")

    def _gathered(self, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered chunks, one after the other, and where each chunk's end."""
        self._learn()
        n = np.array(numbers, dtype=np.int64)
        sizes = self.size[n]
        ends = np.cumsum(sizes)
        out = self.ids[_spans(self.at[n], sizes)]
        hits = np.bincount(n, minlength=self.count[0])
        hits[:len(self.hits)] += self.hits
        self.hits = hits
        if self.count[0] > self.bound:
            self._thin()
        return out, ends

    def _long(self, parts: list[str]) -> bytes:
        """A very long text goes through the bounded table in blocks."""
        out = [self._plain(parts[0]).tobytes()]
        for b in range(1, len(parts), BLOCK):
            out.append(self._gathered(list(map(self.inner.__getitem__, parts[b:b + BLOCK])))[0].tobytes())
        return b"".join(out) + END

    def batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes, the end id appended, in order."""
        numbers: list[int] = []
        ends: list[int] = []  # of the waiting texts, in numbers

        def flush() -> Iterator[bytes]:
            if ends:
                ids, at = self._gathered(numbers)
                raw, begin = ids.tobytes(), 0
                for end in (4 * at[np.array(ends) - 1]).tolist():
                    yield raw[begin:end] + END
                    begin = end
                numbers.clear()
                ends.clear()
        for text in texts:
            if not text or any(s in text for s in self.special):  # empty, or it spells a special token: as the tokenizer takes it
                yield from flush()
                yield (self._plain(text).tobytes() if text else b"") + END
                continue
            parts = self._parts(text)
            if len(parts) >= BLOCK:
                yield from flush()
                yield self._long(parts)
                continue
            numbers.append(self.first[parts[0]])
            numbers += map(self.inner.__getitem__, parts[1:])
            ends.append(len(numbers))
            if len(numbers) >= GROUP:
                yield from flush()
        yield from flush()
