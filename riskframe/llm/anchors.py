"""Anchors: positions picked by content, so that equal stretches of two sequences pick the same ones.

Sequences are arrays of unsigned 64-bit values (a random value for each byte, or hashed words).
An anchor is the start of a k-gram whose hash is the smallest of some ``w`` consecutive k-grams;
every stretch of k + w - 1 values holds one, and equal stretches hold them at equal offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15  # fixed value: an odd 64-bit multiplier
SEGMENT = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive values: a wrapping polynomial, put together by doubling."""
    if len(x) < k:
        return np.empty(0, np.uint64)
    run, size, out, have = x, 1, None, 0
    while True:
        factor = np.uint64(pow(BASE, size, 1 << 64))
        if k & size:
            if out is None:
                out, have = run, size
            else:
                n = len(x) - have - size + 1
                out, have = out[:n] * factor + run[have:have + n], have + size
        if 2 * size > k:
            return mixed(out[:len(x) - k + 1])
        run, size = run[:len(run) - size] * factor + run[size:], 2 * size


def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        x, size = pick(x[:len(x) - size], x[size:]), 2 * size
    return pick(x[:len(x) - (w - size)], x[w - size:]) if w > size else x


def anchors(x: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, k-gram hashes) of the anchors of a sequence, in order; long ones in overlapping segments."""
    where, what = [], []
    for at in range(0, max(1, len(x) - k - w + 2), SEGMENT):
        h = gram_hashes(x[at:at + SEGMENT + k + w - 2], k)
        if len(h) < w:
            continue
        least = _sliding(h, w, np.minimum)
        edge = np.zeros(w - 1, np.uint64)
        found = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), w, np.maximum) == h)
        where.append(found + at)
        what.append(h[found])
    if not where:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    pos, first = np.unique(np.concatenate(where), return_index=True)
    return pos, np.concatenate(what)[first]


def joined_anchors(x: np.ndarray, sizes: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in ``x``, sequence numbers, k-gram hashes) of the anchors of sequences laid end to end in ``x``."""
    where, what = [], []
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, max(1, len(x) - k - w + 2), SEGMENT):
        h = gram_hashes(x[at:at + SEGMENT + k + w - 2], k)
        if len(h) < w:
            continue
        least = _sliding(h, w, np.minimum)
        n = len(least)
        least[owner[at:at + n] != owner[at + k + w - 2:at + k + w - 2 + n]] = 0  # no stretch crosses sequences
        edge = np.zeros(w - 1, np.uint64)
        found = np.flatnonzero((_sliding(np.concatenate([edge, least, edge]), w, np.maximum) == h) & (h > 0))
        where.append(found + at)
        what.append(h[found])
    if not where:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    pos, first = np.unique(np.concatenate(where), return_index=True)
    return pos, owner[pos], np.concatenate(what)[first]


def signed(x: np.ndarray) -> list[int]:
    """64-bit values as Spark longs."""
    return x.astype(np.uint64).view(np.int64).tolist()


def merged(spans: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching [start, end) spans as maximal runs."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]
