"""Words of many texts as 128-bit digests, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

from tradelane.llm.phrases import mix

U = np.uint64
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Longer words (bytes) are digested one by one.
LONG = 64
_FIRST, _SECOND = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


def word_digests(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(digests, count)``: a (2, words) array over all texts laid end to end, and the words of each.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word is read in lanes of eight bytes, each mixed into two
    64-bit numbers that start from the word's length; every step is one-to-one in the lane.
    """
    data = np.frombuffer(b" ".join([t or b"" for t in texts]) + b" " * 9, dtype=np.uint8)
    inside = np.concatenate([[False], ~SPACE[data]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edge[::2], edge[1::2] - edge[::2]
    bounds = np.cumsum([len(t or b"") + 1 for t in texts]) if texts else np.zeros(0, dtype=np.int64)
    count = np.diff(np.searchsorted(start, bounds), prepend=0)
    a, b = size.astype(np.uint64) * _FIRST, size.astype(np.uint64) * _SECOND
    lanes = np.lib.stride_tricks.sliding_window_view(data, 8)
    rest, at = size, np.arange(len(start))
    short = size <= LONG
    k = 0
    while True:
        here = short[at] & (rest[at] > 0) if k == 0 else rest[at] > 0
        at = at[here]
        if not len(at):
            break
        left = np.minimum(rest[at], 8).astype(np.uint64)
        lane = lanes[start[at] + 8 * k].view(np.uint64)[:, 0] & (U(0xFFFFFFFFFFFFFFFF) >> (U(64) - U(8) * left))
        a[at] = mix(a[at] ^ lane) + _SECOND
        b[at] = mix(b[at] + lane * _FIRST) ^ _FIRST
        rest = rest - 8
        k += 1
    raw = data.tobytes() if not short.all() else b""
    for i in np.flatnonzero(~short).tolist():
        found = hashlib.blake2b(raw[start[i] : start[i] + size[i]], digest_size=16).digest()
        a[i], b[i] = np.frombuffer(found, dtype=np.uint64)
    return np.stack([a, b]), count
