"""Words of whole texts as 64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: A random odd factor for each place in a run, and its inverse; a random number for each byte.
FACTOR = np.uint64(0xD1342543DE82EF95)
INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))
BYTE_CODES = np.random.default_rng(11).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    powers = np.empty((2, 1 << bits), np.uint64)
    for row, factor in zip(powers, (FACTOR, INVERSE), strict=True):
        row[0], size = 1, 1
        while size < len(row):
            row[size : 2 * size] = row[:size] * factor
            factor, size = factor * factor, 2 * size
    return powers[0], powers[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = _powers(max(12, int(size).bit_length()))
    return up[: size + 1], down[: size + 1]


@dataclass
class Words:
    """The words of some texts: their hashes, the bytes they span, and the texts' borders among them."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    borders: np.ndarray

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of that many words inside one text, and the place of their first words."""
        if len(self.hashes) < length:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        counts = np.diff(self.borders)
        left = np.repeat(self.borders[1:], counts) - np.arange(len(self.hashes))
        places = np.flatnonzero(left >= length)
        return run_hashes(self.hashes, places, places + length), places


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs [start, end): the same for the same words wherever they stand."""
    with np.errstate(over="ignore"):
        up, down = powers(len(hashes))
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        return scramble((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def words_of(
    data: np.ndarray, borders: np.ndarray, lower: bool = False, outside: np.ndarray = SPACES
) -> Words:
    """Words are maximal runs of bytes that are not outside: space and U+0009-U+000D by default.

    lower folds A-Z only.
    """
    if lower:
        data = folded(data)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(borders), np.int64))
    inside = ~outside[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = borders[(borders > 0) & (borders < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = run_hashes(BYTE_CODES[data], starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(starts, borders).astype(np.int64))
