"""A suffix automaton of many sequences, with counts of occurrences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """States of all substrings of the sequences added. ``count`` is how often a state's substrings occur, a
    sequence added with ``times`` counting so often; it holds after ``finish``."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, sequence: Iterable, times: int = 1) -> None:
        state = 0
        for symbol in sequence:
            state = self._extend(state, symbol)
            self.count[state] += times

    def _extend(self, last: int, symbol) -> int:
        arcs, link, length = self.next, self.link, self.length
        there = arcs[last].get(symbol)
        if there is not None:  # an earlier sequence has led here
            return there if length[there] == length[last] + 1 else self._split(last, symbol, there)
        new = len(arcs)
        arcs.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.count.append(0)
        p = last
        while p != -1 and symbol not in arcs[p]:
            arcs[p][symbol] = new
            p = link[p]
        if p != -1:
            q = arcs[p][symbol]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
        return new

    def _split(self, p: int, symbol, q: int) -> int:
        """The shorter substrings of state ``q``, those that end in ``p``'s and the symbol, become a state of their own."""
        arcs, link = self.next, self.link
        clone = len(arcs)
        arcs.append(arcs[q].copy())
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        while p != -1 and arcs[p].get(symbol) == q:
            arcs[p][symbol] = clone
            p = link[p]
        link[q] = clone
        return clone

    def finish(self) -> None:
        """Adds the counts up along the suffix links, and finds for each state the longest suffix that occurs twice."""
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        count, link, length = self.count, self.link, self.length
        for v in order:
            count[link[v]] += count[v]
        self.repeated = [0] * len(count)
        for v in reversed(order):
            self.repeated[v] = length[v] if count[v] > 1 else self.repeated[link[v]]

    def matching(self, sequence: Sequence) -> list[int]:
        """Matching statistics of a sequence that was added: for each place, the length of the longest substring that ends
        there and occurs a second time."""
        out, state, arcs, repeated = [], 0, self.next, self.repeated
        for n, symbol in enumerate(sequence, 1):
            state = arcs[state][symbol]
            out.append(min(n, repeated[state]))
        return out
