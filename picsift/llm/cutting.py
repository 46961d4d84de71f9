"""The cutting-stock problem over a histogram of lengths, solved by column generation.

A pattern says how many pieces of each length class share one sequence.  The linear program
asks for the fewest sequences whose patterns use up every piece; it is solved by the revised
simplex method over the patterns known so far, and a knapsack by dynamic programming prices the
pattern that would help most, until none does.  Its size is that of the histogram (``classes``
rows), whatever the number of documents.  Rounding errors can cost fullness only: whole patterns are
counted against the demand.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Stop when the optimum is at most this share below what is reached, or after so many patterns.
GAP, MOST_PATTERNS = 2e-4, 20_000
_TINY = 1e-9


@dataclass
class Pattern:
    """``counts[k]``: pieces of class k (of ``k`` grid steps) in each of ``times`` sequences."""

    counts: dict[int, int]
    times: int

    @property
    def filled(self) -> int:
        return sum(k * n for k, n in self.counts.items())


def knapsack(sizes: np.ndarray, values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of items (number of each) that fits ``room``, and its value."""
    best, taken = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        fits = int(np.searchsorted(sizes, c, side="right"))
        best[c] = best[c - 1]
        if fits:
            worth = values[:fits] + best[c - sizes[:fits]]
            i = int(worth.argmax())
            if worth[i] > best[c] + _TINY:
                best[c], taken[c] = worth[i], i
    counts, c = np.zeros(len(sizes), dtype=np.int64), room
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            counts[taken[c]] += 1
            c -= int(sizes[taken[c]])
    return float(best[room]), counts


def solve(demand: dict[int, int], room: int, gap: float = GAP) -> list[tuple[np.ndarray, float]]:
    """(pattern over the sorted sizes of ``demand``, how often: a real number) of the linear program's basis."""
    sizes = np.array(sorted(k for k, n in demand.items() if n > 0), dtype=np.int64)
    if not len(sizes):
        return []
    wanted = np.array([demand[int(k)] for k in sizes], dtype=np.float64)
    basis = np.diag(room // sizes).astype(np.float64)            # columns: one pattern for each size
    inverse = np.diag(1 / (room // sizes))
    amount = wanted / (room // sizes)
    for _ in range(MOST_PATTERNS):
        prices = inverse.sum(axis=0)                             # every pattern costs one sequence
        value, counts = knapsack(sizes, prices, room)
        if value <= 1 + gap:                                     # total / value bounds the optimum from below
            break
        way = (inverse * counts).sum(axis=1)                     # no BLAS: its threads stall on a busy driver
        up = way > _TINY
        ratio = np.where(up, amount / np.where(up, way, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * way
        amount[out] = ratio[out]
        amount[amount < 0] = 0
        basis[:, out] = counts
        row = inverse[out] / way[out]
        inverse = inverse - np.outer(way, row)
        inverse[out] = row
    return [(basis[:, i].astype(np.int64), float(x)) for i, x in enumerate(amount)]


def patterns(demand: dict[int, int], room: int) -> list[Pattern]:
    """Whole patterns, fullest first: the program's amounts rounded down, cut where the demand is used up."""
    sizes = sorted(k for k, n in demand.items() if n > 0)
    left = {k: demand[k] for k in sizes}
    out = []
    for counts, amount in sorted(solve(demand, room), key=lambda p: -int(p[0] @ np.array(sizes, dtype=np.int64)) if len(sizes) else 0):
        used = {k: int(n) for k, n in zip(sizes, counts) if n}
        times = min([int(amount + 1e-6), *(left[k] // n for k, n in used.items())]) if used else 0
        if times > 0:
            out.append(Pattern(used, times))
            for k, n in used.items():
                left[k] -= times * n
    return out
