"""Words, shingles and their hashes, for whole batches of texts at once.

Words end at space and the five characters from tab to carriage return; A-Z are
lower-cased first. Hashes are 64-bit and depend on the bytes alone.
"""

from __future__ import annotations

import numpy as np

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= _MIX_1
    x ^= x >> np.uint64(33)
    x *= _MIX_2
    x ^= x >> np.uint64(33)
    return x


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def words(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every word, the number of its text, and its last two bytes, in order."""
    joined = np.frombuffer(b" ".join(data) + b" ", dtype=np.uint8)
    inside = ~_SPACES[joined]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    first, last = edge[::2], edge[1::2]
    sizes = np.array([len(t) + 1 for t in data], dtype=np.int64)
    text = np.searchsorted(np.cumsum(sizes), first, side="right")
    up, down = _powers_to(len(joined))
    low = _LOWER[joined]
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = (sums[last] - sums[first]) * down[first]
    ending = low[last - 1].astype(np.int64) << 8 | low[np.maximum(last - 2, first)]
    return mixed(hashes + (last - first).astype(np.uint64) * _MIX_2), text, ending


def shingles(data: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``width`` words, and where each text's begin (one more entry: the end).

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    word, text, _ = words(data)
    counts = np.bincount(text, minlength=len(data))
    begin = np.concatenate(([0], np.cumsum(counts)))
    n = np.maximum(counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(starts[-1]) - np.repeat(starts[:-1], n) + np.repeat(begin[:-1], n)
    size = np.repeat(np.minimum(counts, width), n)
    out = size.astype(np.uint64) * _MIX_1
    padded = np.concatenate((word, np.zeros(width, dtype=np.uint64)))
    for k in range(width):
        out = mixed(out * _BASE + np.where(k < size, padded[at + k], np.uint64(0)) + np.uint64(k))
    return out, starts


def shingle_set(text: bytes, width: int = 5) -> frozenset:
    """The shingles themselves, for exact comparison."""
    w = text.lower().split()
    return frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])
