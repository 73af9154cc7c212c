"""A minimal acyclic acceptor of words, and its composition with a one-edit transducer and itself."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class Acceptor:
    """The minimal acyclic automaton of sorted distinct words: states that accept the same tails are one state."""

    def __init__(self, words: Sequence[str]):
        self.words = words
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._tails: dict[tuple[int, int], list[str]] = {}
        self.start = self._state(0, len(words), 0)

    def _state(self, lo: int, hi: int, depth: int) -> int:
        """The state that accepts the tails, from ``depth`` on, of words lo to hi, which agree before it."""
        final = lo < hi and len(self.words[lo]) == depth
        arcs, at = {}, lo + final
        while at < hi:
            letter, end = self.words[at][depth], at + 1
            while end < hi and self.words[end][depth] == letter:
                end += 1
            arcs[letter] = self._state(at, end, depth + 1)
            at = end
        key = (final, tuple(arcs.items()))
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[key]

    def common_tails(self, p: int, q: int) -> list[str]:
        """The tails that both states accept: the composition after its edit, where both sides read the same."""
        key = (p, q) if p < q else (q, p)
        found = self._tails.get(key)
        if found is None:
            found = [""] if self.final[p] and self.final[q] else []
            few, many = sorted((self.arcs[p], self.arcs[q]), key=len)
            for letter, to in few.items():
                if letter in many:
                    found += [letter + tail for tail in self.common_tails(to, many[letter])]
            self._tails[key] = found
        return found

    def one_edit_pairs(self) -> Iterator[tuple[str, str]]:
        """Every pair of accepted words that differ by one replaced, inserted or deleted letter, once.

        The composition reads the same on both sides up to the pair's first
        difference, takes one edit arc there, and reads the same afterwards.
        """
        path: list[tuple[int, str]] = [(self.start, "")]
        while path:
            state, before = path.pop()
            arcs = self.arcs[state]
            letters = list(arcs)
            for i, a in enumerate(letters):
                for b in letters[i + 1:]:  # replace a by b
                    for tail in self.common_tails(arcs[a], arcs[b]):
                        yield before + a + tail, before + b + tail
                for tail in self.common_tails(arcs[a], state):  # delete a; the next letter differs, or the first difference is later
                    if tail[:1] != a:
                        yield before + a + tail, before + tail
                path.append((arcs[a], before + a))
