"""Content-defined chunks: cuts fall at the valleys of a gear rolling hash."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tallymart.llm.common import mixed

#: Bytes that the rolling hash looks back on.
WINDOW = 16
HIGHEST = np.uint64((1 << 64) - 1)


@dataclass(frozen=True)
class Cutter:
    """A cut falls behind a byte whose rolling hash is less than those of ``reach`` bytes to either side.

    Chunks are thus longer than ``reach`` and about twice that on average. A cut depends on the
    bytes near it alone, so an insertion moves no cut far from it. What is longer than
    ``largest``, as in text that repeats itself, is split at that distance from its own start.
    """

    reach: int
    largest: int

    def __post_init__(self) -> None:
        if not WINDOW <= self.reach < self.largest:
            raise ValueError("chunk sizes must fit: window <= reach < largest")

    def cuts(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where chunks begin, all texts' in a row, and how many each text has."""
        lengths = np.diff(starts)
        found = self.valleys(data, starts) + 1
        begins = np.sort(np.concatenate([starts[:-1][lengths > 0], found]))
        ends = np.concatenate([begins[1:], [starts[-1]]]) if len(begins) else begins
        pieces = -(-(ends - begins) // self.largest)
        first = np.repeat(begins, pieces)
        within = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begins = first + within * self.largest
        counts = np.bincount(np.searchsorted(starts, begins, side="right") - 1, minlength=len(lengths))
        return begins, counts

    def valleys(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bytes behind which a cut falls; none in the first window of a text or as its last byte."""
        lengths, reach = np.diff(starts), self.reach
        shift = np.repeat(np.arange(1, len(lengths) + 1) * reach, lengths)
        place = np.arange(len(data)) + shift
        own = np.full(len(data) + (len(lengths) + 1) * reach + 1, HIGHEST)
        hashes = rolling(data)
        own[place] = hashes
        for k in range(WINDOW):  # where the hash still sees the text before
            own[place[starts[:-1][lengths > k] + k]] = HIGHEST
        least, width = own, 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: -(reach - width)], least[reach - width :])
        value = own[place]
        cut = (value < least[place - reach]) & (value < least[place + 1])
        cut[starts[1:][lengths > 0] - 1] = False
        return np.flatnonzero(cut)


def gear_table() -> np.ndarray:
    """256 fixed random words, made by rule."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


GEAR = gear_table()


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the gear words of the last ones, each shifted by its distance."""
    sums, width = GEAR[data], 1
    while width < WINDOW:
        later = sums.copy()
        later[width:] += sums[:-width] << np.uint64(width)
        sums, width = later, width * 2
    return sums
