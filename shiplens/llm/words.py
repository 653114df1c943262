"""Words of whole texts as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from shiplens.llm.rows import text_bytes

#: White space between words, and A-Z to lower case.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.default_rng(0x5EED)
_LETTER = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(20, (n - 1).bit_length() if n else 0))
    return up[:n], down[:n]


def words(data: np.ndarray, starts: np.ndarray, lower: bool = True, gaps: np.ndarray = SPACE):
    """Hash, begin and end byte of each word, and how many words each text has; `gaps` are the bytes
    between words."""
    inside = ~gaps[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = starts[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]  # a text's first byte opens a word, its last ends one
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[LOWER[data] if lower else data] * up[: len(data)], out=total[1:])
    hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    counts = np.diff(np.searchsorted(first, starts))
    return hashes, first, last, counts


def grams(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `size` words within each text, and the runs each text has; a text of fewer
    words, but one at least, is one run as a whole."""
    ends = np.cumsum(counts)
    room = np.maximum(counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(ends - counts, room) + (np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room))
    have = np.repeat(np.minimum(counts, size), room)
    out = have.astype(np.uint64) * _PLACE[63]
    for k in range(size):
        if len(hashes):
            at = np.minimum(first + k, len(hashes) - 1)
            out += np.where(have > k, hashes[at] * _PLACE[k], np.uint64(0))
    return mix(out), room


def shingle_sets(column: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Each text's distinct runs of words, sorted; empty for texts without words."""
    data, starts = text_bytes(column)
    hashes, _, _, counts = words(data, starts)
    runs, room = grams(hashes, counts, size)
    ends = np.cumsum(room).tolist()
    return [np.unique(runs[e - n : e]) for e, n in zip(ends, room.tolist())]


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets have in common."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())
