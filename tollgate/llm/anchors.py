"""Minimisers: places that texts choose by their content alone, alike wherever a passage stands."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tollgate.llm.words import FACTOR, Words, run_hashes, scramble


def minimisers(words: Words, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of `length` words that are the smallest of `window` successive ones: hashes and places.

    Two equal passages of window + length - 1 words choose the same run at the same place in them.
    Of equal hashes the first is taken. Shorter texts choose nothing.
    """
    hashes, places = words.runs(length)
    if len(hashes) < window:
        return hashes[:0], places[:0]
    # smallest of each window by doubling: position of the first smallest of 1, 2, 4, ... runs
    best, span = np.arange(len(hashes)), 1
    while span < window:
        step = min(span, window - span)
        left, right = best[:-step], best[step:]
        best, span = np.where(hashes[right] < hashes[left], right, left), span + step
    # windows must not cross texts: their runs' places follow one another
    begin, end = places[: len(best)], places[window - 1 :]
    chosen = np.unique(best[end - begin == window - 1])
    return hashes[chosen], places[chosen]


def keyed(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that differ by row too, so that one set operation serves many rows."""
    with np.errstate(over="ignore"):
        return scramble(hashes + rows.astype(np.uint64) * FACTOR)


def flatten(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a column of lists, and the row of each; a null list is empty."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(np.arange(len(lists)), counts)


def repeats(keys: np.ndarray) -> np.ndarray:
    """True for every key that occurs more than once."""
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[which] > 1


class Passages:
    """The windows of `length` words of some texts that hold chosen minimisers."""

    def __init__(self, words: Words, length: int, anchor: int):
        self.words, self.length, self.anchor = words, length, anchor
        self.row_of = np.repeat(np.arange(len(words.borders) - 1), np.diff(words.borders))
        self.hashes, self.places = minimisers(words, anchor, length - anchor + 1)
        self.rows = self.row_of[self.places]
        self.keys = keyed(self.hashes, self.rows)

    def starts(self, chosen: np.ndarray) -> np.ndarray:
        """Where the windows begin that hold one of the chosen minimisers."""
        places, rows, borders = self.places[chosen], self.rows[chosen], self.words.borders
        first = np.maximum(places + self.anchor - self.length, borders[rows])
        last = np.minimum(places, borders[rows + 1] - self.length)
        change = np.zeros(len(self.words.hashes) + 1, np.int64)
        np.add.at(change, first[first <= last], 1)
        np.add.at(change, last[first <= last] + 1, -1)
        return np.flatnonzero(np.cumsum(change) > 0)

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows' hashes, rows, and keys that tell rows apart."""
        hashes = run_hashes(self.words.hashes, starts, starts + self.length)
        rows = self.row_of[starts]
        return hashes, rows, keyed(hashes, rows)

    def cover(self, starts: np.ndarray) -> np.ndarray:
        """True for every word inside one of the windows that begin there."""
        change = np.zeros(len(self.words.hashes) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + self.length, -1)
        return np.cumsum(change)[:-1] > 0
