"""Which tokens may follow each other in a byte-pair encoding.

A sequence of tokens is the encoding of its text exactly if every adjacent pair is the
encoding of its own two texts joined. So a prefix's encoding ends in the one token that
may follow the last token of the shorter prefix before it.
"""

from __future__ import annotations

from collections.abc import Callable

_NEVER = float("inf")


def merge(symbols: list, rank: Callable, done: list | None = None) -> list:
    """Plain byte-pair merging: the lowest ranked adjacent pair first, leftmost on ties.

    ``done`` collects the merges: rank, place, left and right symbol.
    """
    symbols = list(symbols)
    while len(symbols) > 1:
        ranks = [rank(a, b) for a, b in zip(symbols, symbols[1:], strict=False)]
        best = min(ranks)
        if best == _NEVER:
            break
        at = ranks.index(best)
        if done is not None:
            done.append((best, at, len(symbols)))
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


class Pairs(dict):
    """(left << 20 | right) to whether token ``right`` may follow ``left``; filled on use.

    ``rank(a, b)`` is the rank of merging a and b, infinite if they don't merge.
    """

    def __init__(self, pieces: list, split: Callable, rank: Callable, most: int = 500_000):
        super().__init__()
        self.pieces, self.split, self.rank, self.most = pieces, split, rank, most
        self.edges: dict[int, tuple | None] = {}

    def _edge(self, token: int) -> tuple | None:
        """How the token's first and its last symbol grow: (symbol, rank of its next merge).

        None if its merges don't come in order of rank or don't end in the token.
        """
        parts, done = self.split(self.pieces[token]), []
        ranks = [0]
        first, last = [[parts[0], _NEVER]], [[parts[-1], _NEVER]]
        symbols = list(parts)
        whole = merge(parts, self.rank, done)
        for rank, at, size in done:
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            ranks.append(rank)
            if at == 0:
                first[-1][1] = rank
                first.append([symbols[0], _NEVER])
            if at == size - 2:
                last[-1][1] = rank
                last.append([symbols[-1], _NEVER])
        ordered = all(a <= b for a, b in zip(ranks[1:], ranks[2:], strict=False))
        found = (first, last) if ordered and len(whole) == 1 else None
        self.edges[token] = found
        return found

    def _follows(self, left: int, right: int) -> bool:
        edges = self.edges
        ends = edges[left] if left in edges else self._edge(left)
        begins = edges[right] if right in edges else self._edge(right)
        if ends is None or begins is None:
            a, b = self.pieces[left], self.pieces[right]
            return merge(self.split(a + b), self.rank) == [a, b]
        # Both grow by rank; a merge across the border must never come first.
        ends, begins, i, j, rank = ends[1], begins[0], 0, 0, self.rank
        while True:
            (x, x_until), (y, y_until) = ends[i], begins[j]
            across = rank(x, y)
            if across < x_until and across <= y_until and across != _NEVER:
                return False
            if x_until == y_until == _NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def __missing__(self, pair: int) -> bool:
        ok = self._follows(pair >> 20, pair & 0xFFFFF)
        if len(self) >= self.most:
            self.clear()
        self[pair] = ok
        return ok
