"""Cutting-stock plans from a histogram of lengths, by column generation.

The linear program has one row per distinct length and one column per pattern (how many pieces of each length fill a
sequence). Knapsack dynamic programming prices patterns with the duals; the basis is kept as an explicit inverse. All
sizes are bounded by the sequence length, whatever the number of documents.
"""

from __future__ import annotations

import numpy as np


def best_pattern(lengths: np.ndarray, prices: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of lengths within ``size``; ``lengths`` ascend."""
    value, pick = np.zeros(size + 1), np.full(size + 1, -1)
    fits = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for room in range(1, size + 1):
        value[room] = value[room - 1]
        if k := fits[room]:
            gain = prices[:k] + value[room - lengths[:k]]
            j = int(gain.argmax())
            if gain[j] > value[room] + 1e-12:
                value[room], pick[room] = gain[j], j
    counts, room = np.zeros(len(lengths), dtype=np.int64), size
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            counts[pick[room]] += 1
            room -= int(lengths[pick[room]])
    return float(value[size]), counts


def solve(lengths: np.ndarray, demand: np.ndarray, size: int, gap: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, fractionally. Ends when the bound is within ``gap``."""
    m = len(lengths)
    basis = np.diag(size // lengths).astype(float)
    cost = np.ones(m)
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ demand
    for turn in range(rounds):
        if turn and turn % 400 == 0:  # rounding errors add up
            inverse = np.linalg.inv(basis)
            use = np.maximum(inverse @ demand, 0)
        prices = np.einsum("i,ij->j", cost, inverse)  # einsum keeps to one thread; small products gain nothing from more
        low = int(prices.argmin())
        if prices[low] < -1e-9:
            column, price = np.zeros(m), 0.0
            column[low] = -1.0
        else:
            value, counts = best_pattern(lengths, np.maximum(prices, 0), size)
            if value <= 1 + gap:  # the optimum is at least the present one divided by this value
                break
            column, price = counts.astype(float), 1.0
        way = np.einsum("ij,j->i", inverse, column)
        rows = np.flatnonzero(way > 1e-9)
        if not len(rows):
            break
        leave = rows[(use[rows] / way[rows]).argmin()]
        step = use[leave] / way[leave]
        use = np.maximum(use - step * way, 0)
        use[leave] = step
        basis[:, leave], cost[leave] = column, price
        pivot = inverse[leave] / way[leave]
        inverse -= np.outer(way, pivot)
        inverse[leave] = pivot
    real = cost > 0
    return basis[:, real].round().astype(np.int64), use[real]


def fill(lengths: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Best-fit decreasing for what rounding leaves: the longest piece that still fits goes in next."""
    left, out = counts.copy(), []
    while left.sum():
        row, room = np.zeros(len(lengths), dtype=np.int64), size
        while True:
            fits = np.flatnonzero((left > 0) & (lengths <= room))
            if not len(fits):
                break
            j = fits[-1]
            n = min(int(left[j]), room // int(lengths[j])) if not row.any() else 1
            row[j] += n
            left[j] -= n
            room -= n * int(lengths[j])
        out.append(row)
    return out


def plan(histogram: dict[int, int], size: int, gap: float = 1e-3, rounds: int = 2000) -> list[tuple[int, list[tuple[int, int]]]]:
    """How often to make a sequence, and of how many pieces of which lengths; uses every piece once."""
    todo = {k: n for k, n in sorted(histogram.items()) if k < size and n}
    out = [(histogram[size], [(size, 1)])] if histogram.get(size) else []
    if not todo:
        return out
    lengths, demand = np.array(list(todo)), np.array(list(todo.values()))
    patterns, use = solve(lengths, demand.astype(float), size, gap, rounds)
    times = np.floor(use + 1e-9).astype(np.int64)
    for i in np.flatnonzero(patterns @ times > demand):  # a plan may cover more than there is
        for p in np.flatnonzero(patterns[i] * times):
            over = int(patterns[i] @ times - demand[i])
            if over <= 0:
                break
            times[p] -= min(int(times[p]), -(-over // int(patterns[i, p])))
    made = [(int(n), patterns[:, p]) for p, n in enumerate(times) if n]
    made += [(1, row) for row in fill(lengths, demand - patterns @ times, size)]
    return out + [(n, [(int(lengths[i]), int(row[i])) for i in np.flatnonzero(row)[::-1]]) for n, row in made]
