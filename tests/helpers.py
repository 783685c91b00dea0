"""Small inputs and brute-force answers."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

START = datetime(2024, 3, 1)
TICKS = "t timestamp, p double"


def series_rows(n: int, seed: int = 1, start: datetime = START) -> list[tuple[datetime, float]]:
    """Distinct times in bursts: many in one second, then gaps of minutes or days."""
    rng = random.Random(seed)
    now, rows = start, []
    for _ in range(n):
        step = rng.choices([1, 2_000, 70_000_000, 90_000_000_000], weights=[60, 30, 9, 1])[0]
        now += timedelta(microseconds=step + rng.randrange(step))
        rows.append((now, round(rng.uniform(10, 20), 2)))
    return rows


def flat_rows(prices: list[float], start: datetime = START) -> list[tuple[datetime, float]]:
    return [(start + timedelta(seconds=i), p) for i, p in enumerate(prices)]


def expected_labels(prices: list[float], size: int = 100, eps: float = 0.02) -> dict[int, int | None]:
    """Walk over the windows one after the other."""
    mean = lambda xs: sum(round(x * 1_000_000) for x in xs) / (len(xs) * 1_000_000)
    out: dict[int, int | None] = {}
    full = len(prices) // size
    for w in range(full):
        here = prices[w * size : (w + 1) * size]
        after = prices[(w + 1) * size : (w + 2) * size]
        if not after:
            out[w] = None
            continue
        a, b = mean(here[:99]), mean(after[:19] if len(after) == size else after)
        out[w] = 1 if abs(a - b) < eps else 0 if a > b else 2
    return out
