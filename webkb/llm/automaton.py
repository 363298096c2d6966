"""Suffix automaton of a shard of reference segments.

States carry the smallest rank of the documents whose segments hold their
substrings, so a segment streamed over the automaton learns, for each window
of the threshold length, the first document that has the same words.
"""

from __future__ import annotations


class SuffixAutomaton:
    """Generalised automaton over sequences of symbols, each with a rank."""

    def __init__(self) -> None:
        self.length = [0]
        self.link = [-1]
        self.next: list[dict] = [{}]
        self.rank: list[int | None] = [None]

    def _clone(self, of: int, length: int, parent: int, symbol) -> int:
        at = len(self.length)
        self.length.append(length)
        self.link.append(self.link[of])
        self.next.append(dict(self.next[of]))
        self.rank.append(None)
        self.link[of] = at
        go = self.next
        while parent >= 0 and go[parent].get(symbol) == of:
            go[parent][symbol] = at
            parent = self.link[parent]
        return at

    def add(self, symbols, rank: int) -> None:
        """Insert one sequence; every prefix's state learns ``rank``."""
        length, link, go, ranks = self.length, self.link, self.next, self.rank
        last = 0
        for symbol in symbols:
            known = go[last].get(symbol)
            if known is not None:
                if length[known] != length[last] + 1:
                    known = self._clone(known, length[last] + 1, last, symbol)
                last = known
            else:
                at = len(length)
                length.append(length[last] + 1)
                go.append({})
                ranks.append(None)
                link.append(0)
                p = last
                while p >= 0 and symbol not in go[p]:
                    go[p][symbol] = at
                    p = link[p]
                if p >= 0:
                    q = go[p][symbol]
                    link[at] = q if length[q] == length[p] + 1 else self._clone(q, length[p] + 1, p, symbol)
                last = at
            if ranks[last] is None or rank < ranks[last]:
                ranks[last] = rank

    def settle(self) -> None:
        """Carry ranks from longer states to their suffixes; call once, after all adds."""
        link, ranks = self.link, self.rank
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up, rank = link[v], ranks[v]
            if up > 0 and rank is not None and (ranks[up] is None or rank < ranks[up]):
                ranks[up] = rank

    def first_ranks(self, symbols, window: int) -> list[int | None]:
        """Matching statistics cut at ``window``: for each window of the
        sequence the smallest rank that holds it, None where the match is
        shorter."""
        length, link, go, ranks = self.length, self.link, self.next, self.rank
        state, matched, out = 0, 0, []
        for i, symbol in enumerate(symbols):
            while state and symbol not in go[state]:
                state = link[state]
                matched = length[state]
            if symbol in go[state]:
                state = go[state][symbol]
                matched += 1
            while matched >= window and length[link[state]] >= window:
                state = link[state]
            if matched > window:
                matched = window
            if i >= window - 1:
                out.append(ranks[state] if matched >= window else None)
        return out
