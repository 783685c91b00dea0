"""Fuzzy keys from the binary Golay code: words that differ in at most two of 23 bits share a key.

The code is perfect: each of the 2^23 words lies within three bits of one codeword. With a parity bit added, a word is
either within two bits of a single codeword or exactly four bits from six (the tetrads of a sextet). The indices of
these codewords are the word's keys. Take two words that differ in two bits (or one, and the parity): if both bits lie
in one tetrad, or either word is near a single codeword, that codeword is nearest to both; if they lie in two tetrads,
each of the two codewords stays four bits away. Either way a key is shared.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH = 23
_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a fixed value of the code


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; up to six error patterns for a syndrome, and how many."""
    single = [_remainder(1 << i) for i in range(LENGTH)]

    def syndromes(first: int, bits: int) -> np.ndarray:
        out = np.zeros(1 << bits, dtype=np.int32)
        for i in range(bits):
            out[1 << i : 2 << i] = out[: 1 << i] ^ single[first + i]
        return out

    errors, found = np.zeros((2048, 6), dtype=np.int32), np.zeros(2048, dtype=np.int64)
    light = np.zeros(2048, dtype=np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            syndrome = 0
            for i in places:
                syndrome ^= single[i]
            if weight < 4:
                light[syndrome] = weight
            elif light[syndrome] < 3:
                continue
            errors[syndrome, found[syndrome]] = sum(1 << i for i in places)
            found[syndrome] += 1
    return syndromes(0, 12), syndromes(12, 11), errors, found


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``words`` (integers below 2^23) and a codeword index (below 4096) for each key."""
    low, high, errors, found = _tables()
    words = words.astype(np.int64)
    syndrome = low[words & 4095] ^ high[words >> 12]
    counts = found[syndrome]
    at = np.repeat(np.arange(len(words)), counts)
    nth = np.arange(len(at)) - np.repeat(counts.cumsum() - counts, counts)
    return at, (words[at] ^ errors[syndrome[at], nth]) >> 11
