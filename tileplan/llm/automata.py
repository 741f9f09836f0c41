"""Suffix automaton of a collection of word sequences, with the occurrences of what its states stand for."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """Accepts every run of words of the sequences added; ``count`` is right after ``finish``."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, words: Sequence[int], weight: int = 1) -> None:
        """Add a sequence that occurs ``weight`` times."""
        last, count = 0, self.count
        for word in words:
            last = self._extended(last, word)
            count[last] += weight

    def _new(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _extended(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._fitting(last, word, known)
        state, at = self._new(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._fitting(at, word, self.next[at][word])
        return state

    def _fitting(self, at: int, word: int, target: int) -> int:
        """The state of the longest run at ``at`` and ``word``; where the target stands for longer runs too, a new one."""
        if self.length[target] == self.length[at] + 1:
            return target
        state = self._new(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = state
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = state
            at = self.link[at]
        return state

    def finish(self) -> None:
        """Add up occurrences: a run occurs wherever a longer run that ends with it does."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def repeated(self, words: Sequence[int], length: int) -> list[tuple[int, int]]:
        """Stream a sequence: runs [begin, end) of the places where ``length`` words begin that occur twice or more.

        The matching statistic, the longest run ending here that the collection has, is followed up to ``length``.
        """
        out: list[tuple[int, int]] = []
        state = matched = 0
        after, link, size, count = self.next, self.link, self.length, self.count
        for end, word in enumerate(words, 1):
            while state and word not in after[state]:
                state = link[state]
                matched = size[state]
            if word in after[state]:
                state, matched = after[state][word], matched + 1
            if matched > length:
                matched = length
            while matched and size[link[state]] >= matched:
                state = link[state]
            if matched == length and count[state] > 1:
                begin = end - length
                if out and out[-1][1] == begin:
                    out[-1] = (out[-1][0], begin + 1)
                else:
                    out.append((begin, begin + 1))
        return out
