"""Rolling hashes of byte strings and the phrases they cut (numpy, one text at a time).

A text's 100-byte windows are cut into runs by content-defined triggers: each window is
given to the smallest rolling hash among its 32-byte substrings (leftmost on ties), and
the consecutive windows with the same trigger are one phrase. The choice depends on the
window's bytes alone, so equal windows always lie in phrases with equal trigger strings
and at equal distances from them; neighbouring phrases overlap by 99 bytes, so every
window lies whole inside exactly one phrase. This is the prefix-free-parsing property
with an overlap of one window: the windows of the corpus are those of its dictionary.
"""

from __future__ import annotations

import numpy as np

TRIGGER = 32
PIECE = 17
U = np.uint64


def _stream(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all 64 bits."""
    h = (h ^ (h >> U(31))) * U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


def tag(h: np.ndarray, windows: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """A phrase's digest, with its length and its trigger's place."""
    return mix(h + (windows * 1024 + offset).astype(np.uint64))


class Roller:
    """Polynomial hashes modulo 2**64 of any substring, by prefix sums."""

    def __init__(self, seed: int):
        self.codes = _stream(seed, 256)
        self.base = int(_stream(seed + 1, 1)[0]) | 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if n > len(self.up):
            self.up = self._powers(self.base, max(n, 1 << 16))
            self.down = self._powers(self.inverse, max(n, 1 << 16))
        sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(self.codes[data] * self.up[: n - 1], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        """Hash of the ``length`` bytes from each ``start``."""
        return (sums[start + length] - sums[start]) * self.down[start]

    def all(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Hash of every substring of ``length`` bytes."""
        return (sums[length:] - sums[:-length]) * self.down[: len(sums) - length]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Parser:
    """Cuts texts into phrases: see the module's text."""

    def __init__(self, window: int):
        if window <= TRIGGER:
            raise ValueError(f"windows have more than {TRIGGER} bytes")
        self.window = window
        self.cores, self.wholes = Roller(11), Roller(29)

    def parse(self, data: np.ndarray):
        """``(trigger hash, phrase hash, start, windows, offset of the trigger)`` per phrase."""
        if len(data) < self.window:
            none, zero = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
            return none, none, zero, zero, zero
        cores = mix(self.cores.all(self.cores.prefix(data), TRIGGER))
        packed = (cores & U(0xFFFFFFFF00000000)) | np.arange(len(cores), dtype=np.uint64)
        at = (sliding_min(packed, self.window - TRIGGER + 1) & U(0xFFFFFFFF)).astype(np.int64)
        start = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        windows = np.diff(np.concatenate([start, [len(at)]]))
        sums = self.wholes.prefix(data)
        whole = self.wholes.of(sums, start, windows + self.window - 1)
        offset = at[start] - start
        return cores[at[start]], tag(whole, windows, offset), start, windows, offset

    def pieces(self, data: np.ndarray, wanted=None):
        """Phrases cut at multiples of ``PIECE`` before their triggers: ``(hash, phrase hash, start, windows)``.

        All windows of a piece contain the ``window - PIECE + 1`` bytes from its cut on,
        which are its trigger. ``wanted`` chooses phrases by trigger hash.
        """
        key, _, start, windows, offset = self.parse(data)
        if wanted is not None and len(key):
            hit = wanted(key)
            start, windows, offset = start[hit], windows[hit], offset[hit]
        if not len(start):
            none, zero = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
            return none, none, zero, zero
        core = start + offset - PIECE * np.arange((self.window - TRIGGER) // PIECE + 1)[:, None]
        low = np.maximum(core - PIECE + 1, start)
        high = np.minimum(core, start + windows - 1)
        slot = np.broadcast_to(np.arange(len(core))[:, None], core.shape)
        some = low <= high
        core, low, high, slot = core[some], low[some], high[some], slot[some]
        sums, cores = self.wholes.prefix(data), self.cores.prefix(data)
        key = mix(self.cores.of(cores, core, self.window - PIECE + 1) + slot.astype(np.uint64))
        whole = self.wholes.of(sums, low, high - low + self.window)
        return key, tag(whole, high - low + 1, core - low), low, high - low + 1

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Hashes of all windows."""
        return mix(self.wholes.all(self.wholes.prefix(data), self.window))


def union(start: np.ndarray, end: np.ndarray):
    """Merge half-open intervals; touching ones become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([first[1:], [True]])
    return start[first], end[last]
