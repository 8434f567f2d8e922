"""Generalised suffix automata over word hashes."""

from __future__ import annotations


class Automaton:
    """All substrings of the sequences added. State 0 is empty; ``nexts``, ``link`` and ``length`` are by state."""

    def __init__(self) -> None:
        self.nexts: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, nexts: dict[int, int]) -> int:
        self.nexts.append(nexts)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        nexts, link = self.nexts, self.link
        copy = self._state(self.length[p] + 1, link[q], dict(nexts[q]))
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def extend(self, last: int, c: int) -> int:
        """The state of the sequence at ``last`` with ``c`` behind it."""
        nexts, link, length = self.nexts, self.link, self.length
        q = nexts[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        now, p = self._state(length[last] + 1, 0, {}), last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = now
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            link[now] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return now

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            last = self.extend(last, c)

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        """Matching statistics: the longest suffix that still matches once ``c`` has been read."""
        nexts, link = self.nexts, self.link
        while state and c not in nexts[state]:
            state = link[state]
            matched = self.length[state]
        to = nexts[state].get(c)
        return (0, 0) if to is None else (to, matched + 1)

    def holder(self, state: int, size: int) -> int:
        """The state of the last ``size`` symbols of what ``state`` stands for."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state
