"""Cutting stock by column generation: patterns of lengths that fill bins with little waste.

The demand is a histogram: how many pieces there are of each length class, at
most one entry per unit of the bin. So all work here is bounded by the size of
a bin, whatever the number of pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np

#: Column generation stops when the bins are within this share of the lower bound.
GAP = 0.002
TINY = 1e-9


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable filling of one bin, any number of pieces of a length: value, copies."""
    useful = prices > TINY
    sizes, worth, index = lengths[useful], prices[useful], np.flatnonzero(useful)
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if fit:
            values = best[room - sizes[:fit]] + worth[:fit]
            top = int(values.argmax())
            if values[top] > best[room] + TINY:
                best[room], choice[room] = values[top], top
    copies, room = np.zeros(len(lengths), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            copies[index[choice[room]]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), copies


def relaxed(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """The linear program: patterns (one per row) and how often each is used, as fractions.

    Primal simplex with one pattern per length to begin with. The knapsack
    prices all patterns; its value also gives a lower bound on the bins.
    """
    n = len(lengths)
    fills = capacity // lengths
    patterns = np.diag(fills)
    inverse = np.diag(1.0 / fills)
    used = demand / fills
    while True:
        prices = inverse.sum(axis=0)
        value, copies = knapsack(lengths, prices, capacity)
        total = used.sum()
        if value <= 1 + 1e-7 or total - prices @ demand / value <= gap * total:
            return patterns, used
        change = inverse @ copies
        rising = change > TINY
        ratio = np.full(n, np.inf)
        ratio[rising] = used[rising] / change[rising]
        leave = int(ratio.argmin())
        step = max(ratio[leave], 0.0)
        used = np.maximum(used - step * change, 0.0)
        used[leave] = step
        row = inverse[leave] / change[leave]
        inverse -= np.outer(change, row)
        inverse[leave] = row
        patterns[leave] = copies


def rest(left: Counter, capacity: int) -> Iterator[Counter]:
    """Bins for what rounding leaves: the longest piece that fits, again and again."""
    while left:
        room, pattern = capacity, Counter()
        for length in sorted(left, reverse=True):
            copies = min(left[length], room // length)
            if copies:
                pattern[length] = copies
                room -= copies * length
        for length, copies in pattern.items():
            left[length] -= copies
        left = +left
        yield pattern


def plan(histogram: Mapping[int, int], capacity: int, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """Patterns (length: copies) and how many bins follow each; they hold exactly the histogram.

    The fractions of the linear program are rounded down, and the pieces left
    over, a few per pattern, are packed greedily.
    """
    if not all(0 < length <= capacity for length in histogram):
        raise ValueError("a piece is longer than a bin")
    sizes = sorted(length for length, count in histogram.items() if count)
    if not sizes:
        return []
    lengths, demand = np.array(sizes), np.array([histogram[length] for length in sizes], float)
    patterns, used = relaxed(lengths, demand, capacity, gap)
    counts, left = [], Counter({length: histogram[length] for length in sizes})
    for copies, times in zip(patterns, np.floor(used + 1e-6).astype(int)):
        pattern = {sizes[i]: int(copies[i]) for i in np.flatnonzero(copies)}
        times = min([int(times), *(left[length] // copies for length, copies in pattern.items())])
        if times > 0:
            counts.append((pattern, times))
            left.subtract({length: copies * times for length, copies in pattern.items()})
    found = Counter(tuple(sorted(pattern.items())) for pattern in rest(+left, capacity))
    return counts + [(dict(pattern), times) for pattern, times in found.items()]
