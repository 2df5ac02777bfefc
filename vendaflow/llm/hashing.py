"""Vectorised 64-bit hashes over raw bytes: prefix sums of a random byte table times powers of an odd number.

Each stretch of bytes gets the same hash wherever it stands. Everything wraps modulo 2**64; `mix` breaks the
linearity before hashes are combined or compared by size.
"""

from __future__ import annotations

import numpy as np

_TABLE = np.random.default_rng(20240131).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hash of any stretch [start, end) of `data` in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_TABLE[data] * _powers(_BASE, n)[:-1], out=self.sums[1:])
        self.back = _powers(_INVERSE, n)

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes outside `gap`, cut at row ends, and the row of each."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of `size`-word shingles per row, ascending, and how many each row has.

    A row with fewer words has its whole sequence as one shingle; one without words has none."""
    rows = len(offsets) - 1
    lowered = LOWER[data]
    starts, ends, owner = word_bounds(lowered, offsets, SPACE)
    words = Rolling(lowered)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    per_row = np.bincount(owner, minlength=rows)
    begin = np.cumsum(per_row) - per_row
    full = np.zeros(max(0, len(words) - size + 1), np.uint64)
    factor = np.uint64(1)
    for j in range(size):
        full += words[j:j + len(full)] * factor
        factor *= _STEP
    full = mix(full + np.uint64(size))
    out, counts = [], np.zeros(rows, np.int64)
    for row in range(rows):
        n, at = per_row[row], begin[row]
        if n >= size:
            found = np.sort(full[at:at + n - size + 1])
            if len(found) > 1:
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif n:
            powers = _powers(int(_STEP), n)
            found = mix(np.array([(words[at:at + n] * powers).sum(dtype=np.uint64)]) + np.uint64(n))
        else:
            continue
        out.append(found)
        counts[row] = len(found)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts
