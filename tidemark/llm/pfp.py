"""Prefix-free parsing of a block of texts with numpy: hashes, triggers, phrases, windows.

A block is the texts' bytes, one after the other. All hashes of substrings come from one running
sum over the block, so that any number of substrings costs a few array operations.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Length of a trigger; one place in ``EVERY`` on average is one.
TRIGGER = 12
EVERY = 24
_RNG = np.random.default_rng(0x5EED)
_BYTE, _BYTE2 = (_RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_BASE, _BASE2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_MIX, _MIX2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
    np.cumprod(np.full(size - 1, base, np.uint64), out=up[1:])
    np.cumprod(np.full(size - 1, pow(base, -1, 2**64), np.uint64), out=down[1:])
    return up, down


def _sized(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(max(1 << 21, 1 << (n + 1).bit_length()), base)
    return up[: n + 1], down[: n + 1]


def mixed(h: np.ndarray, by: np.uint64 = _MIX) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * by
    h = (h ^ (h >> np.uint64(29))) * by
    return h ^ (h >> np.uint64(32))


class Block:
    """The bytes of some texts; text i is ``data[ends[i - 1]:ends[i]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.data, self.offsets, self.length = data, offsets.astype(np.int64), length
        up, self.down = _sized(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def second_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes by other numbers: with the first ones, equal 128 bits stand for equal strings."""
        if not hasattr(self, "sums2"):
            up, self.down2 = _sized(len(self.data), _BASE2)
            self.sums2 = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE2[self.data] * up[: len(self.data)], out=self.sums2[1:])
        return mixed((self.sums2[end] - self.sums2[start]) * self.down2[start], _MIX2)

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, "right") - 1

    def triggers(self) -> np.ndarray:
        """Ends (exclusive) of the triggers that lie in one text."""
        n = len(self.data)
        if n < TRIGGER:
            return np.empty(0, np.int64)
        h = (self.sums[TRIGGER:] - self.sums[:-TRIGGER]) * self.down[: n - TRIGGER + 1]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        ends = np.flatnonzero(h < np.uint64(2**64 // EVERY)) + TRIGGER
        whole = ends - TRIGGER >= self.offsets[self.text_of(ends - 1)]
        return ends[whole]

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the phrases that a window can hold: from the start of a trigger to
        the end of the next one in the same text."""
        ends = self.triggers()
        self.trigger_ends = ends
        if len(ends) < 2:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        texts = self.text_of(ends - 1)
        start, end = ends[:-1] - TRIGGER, ends[1:]
        fits = (texts[:-1] == texts[1:]) & (end - start <= self.length)
        return start[fits], end[fits]

    def candidates(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of window starts, first and last, whose window holds none of the given phrases."""
        n, size = len(self.data), np.diff(self.offsets)
        change = np.zeros(n + 1, np.int32)
        long = size >= self.length
        begin = self.offsets[:-1][long]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + size[long] - self.length + 1, -1)
        low = np.maximum(end - self.length, self.offsets[self.text_of(start)])
        np.add.at(change, low, -(1 << 20))
        np.add.at(change, start + 1, 1 << 20)
        ok = np.concatenate(([False], np.cumsum(change[:n]) == 1, [False]))
        edges = np.flatnonzero(ok[1:] != ok[:-1])
        return edges[::2], edges[1::2] - 1

    def covered(self, starts_low: np.ndarray, starts_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal byte runs covered by windows that start in the given runs; a run may touch
        the end of one text and the start of the next, where it is cut."""
        n = len(self.data)
        change = np.zeros(n + 1, np.int32)
        np.add.at(change, starts_low, 1)
        np.add.at(change, starts_high + self.length, -1)
        inside = np.concatenate(([False], np.cumsum(change[:n]) > 0, [False]))
        edge = inside[1:] != inside[:-1]
        low, high = np.flatnonzero(edge)[::2], np.flatnonzero(edge)[1::2]
        cut = self.offsets[1:-1]
        cut = np.unique(cut[inside[1:][cut] & inside[:-1][cut]]) if len(cut) else cut
        return np.sort(np.append(low, cut)), np.sort(np.append(high, cut))
