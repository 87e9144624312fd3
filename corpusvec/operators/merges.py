"""Merging pairs of symbols in many pieces at once, and choosing the next pair.

Pieces lie end to end in flat arrays, one number for each symbol and one for
the piece it belongs to.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

#: Two symbols side by side.
Pair = tuple[int, int]


def _codes(symbols: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each two neighbours of one piece, and where the first of them is."""
    at = np.flatnonzero(piece[:-1] == piece[1:])
    return symbols[at].astype(np.int64) << 32 | symbols[at + 1].astype(np.int64), at


def holds_any(symbols: np.ndarray, piece: np.ndarray, pairs: np.ndarray, pieces: int) -> np.ndarray:
    """Which of the pieces hold any of the pairs, given as sorted codes."""
    codes, at = _codes(symbols, piece)
    found = np.zeros(pieces, bool)
    if len(pairs):
        place = np.minimum(np.searchsorted(pairs, codes), len(pairs) - 1)
        found[piece[at[pairs[place] == codes]]] = True
    return found


def pair_codes(pairs: Iterable[Pair]) -> np.ndarray:
    return np.sort(np.array([left << 32 | right for left, right in pairs], np.int64))


def pair_sums(symbols: np.ndarray, piece: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(left, right, n, places)`` of neighbours: sums of their pieces' weights, and of its signs."""
    codes, at = _codes(symbols, piece)
    weights = weight[piece[at]]
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    if not len(first):
        return (np.zeros(0, np.int64),) * 4
    # Whole numbers throughout: a sum of doubles would round beyond 2^53.
    n, places = np.add.reduceat(weights, first), np.add.reduceat(np.sign(weights), first)
    return codes[first] >> 32, codes[first] & 0xFFFFFFFF, n, places


def merge(symbols: np.ndarray, piece: np.ndarray, pair: Pair, merged: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces with ``pair`` merged from left to right, and the numbers of those that held it."""
    at = np.flatnonzero((symbols[:-1] == pair[0]) & (symbols[1:] == pair[1]) & (piece[:-1] == piece[1:]))
    if not len(at):
        return symbols, piece, at
    if pair[0] == pair[1]:
        # In a stretch of one symbol every other place begins a pair.
        number = np.arange(len(at))
        opens = np.diff(at, prepend=-2) > 1
        at = at[(number - np.maximum.accumulate(np.where(opens, number, 0))) % 2 == 0]
    out = symbols.copy()
    out[at] = merged
    stay = np.ones(len(symbols), bool)
    stay[at + 1] = False
    return out[stay], piece[stay], np.unique(piece[at])


def merge_with_changes(symbols: np.ndarray, piece: np.ndarray, weight: np.ndarray, pair: Pair, merged: int):
    """Merge, and how the sums of pairs change: ``symbols, piece, (left, right, n, places)``."""
    after, after_piece, touched = merge(symbols, piece, pair, merged)
    if not len(touched):
        return symbols, piece, (np.zeros(0, np.int64),) * 4
    is_touched = np.zeros(len(weight), bool)
    is_touched[touched] = True
    old, new = is_touched[piece], is_touched[after_piece]
    # Old and new state of a piece side by side, the old with its weight taken off.
    changes = pair_sums(
        np.concatenate([symbols[old], after[new]]),
        np.concatenate([piece[old], after_piece[new] + len(weight)]),
        np.concatenate([-weight, weight]),
    )
    held = (changes[2] != 0) | (changes[3] != 0)
    return after, after_piece, tuple(c[held] for c in changes)


class PairQueue:
    """Sums of all pairs, and the best of them: greatest sum, then least in byte order.

    The queue keeps an entry for each sum that a pair ever had. Entries of
    sums that no longer hold are stale and skipped when they come up.
    """

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.sums: dict[Pair, int] = {}
        #: Places of the pair in distinct pieces, which bounds the pieces that hold it.
        self.places: dict[Pair, int] = {}
        self.queue: list[tuple[int, str, str, Pair]] = []

    def change(self, left, right, n, places) -> None:
        for a, b, more, wider in zip(left.tolist(), right.tolist(), n.tolist(), places.tolist()):
            pair = (a, b)
            total = self.sums.get(pair, 0) + more
            self.places[pair] = self.places.get(pair, 0) + wider
            if total:
                self.sums[pair] = total
                heapq.heappush(self.queue, (-total, self.names[a], self.names[b], pair))
            else:
                self.sums.pop(pair, None)
                del self.places[pair]
        if len(self.queue) > 4 * len(self.sums) + 1024:
            self.queue = [(-n, self.names[p[0]], self.names[p[1]], p) for p, n in self.sums.items()]
            heapq.heapify(self.queue)

    def best(self) -> Pair | None:
        while self.queue:
            total, _, _, pair = self.queue[0]
            if self.sums.get(pair) == -total:
                return pair
            heapq.heappop(self.queue)
        return None

    def best_of(self, most: int, places: int) -> list[Pair]:
        """The best pairs in order, as long as their places add up to no more than ``places``; one at least."""
        taken, found, total = [], {}, 0
        while len(found) < most and (pair := self.best()) is not None:
            if found and total + self.places[pair] > places:
                break
            if pair not in found:
                total += self.places[pair]
                found[pair] = True
            taken.append(heapq.heappop(self.queue))
        for entry in taken:
            heapq.heappush(self.queue, entry)
        return list(found)
