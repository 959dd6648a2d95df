"""Array code of the sampled suffix sort: which suffixes are sampled, and hashes of substrings."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

MASK = (1 << 64) - 1
# Odd bases of two polynomial hashes modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INDEX_BITS = np.uint64(24)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i up to 2^bits."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        powers = np.ones(1, dtype=np.uint64)
        step = b
        while len(powers) <= 1 << bits:
            powers = np.concatenate([powers, powers * np.uint64(step)])
            step = step * step & MASK
        out.append(powers)
    return out[0], out[1]


class Hasher:
    """Hashes of any substring of ``data`` (uint8), from one running sum."""

    def __init__(self, data: np.ndarray, base: int):
        bits = max(16, int(len(data)).bit_length())
        self.up, self.down = _powers(base, bits)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        values = data.astype(np.uint64)
        values += np.uint64(1)
        values *= self.up[: len(data)]
        np.cumsum(values, out=self.sums[1:])

    def at(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        part = self.sums[stop] - self.sums[start]
        part *= self.down[start]
        part += (stop - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        return mixed(part)

    def every(self, length: int) -> np.ndarray:
        """The hash of each substring of that length, by start."""
        part = self.sums[length:] - self.sums[:-length]
        part *= self.down[: len(part)]
        return mixed(part)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by start."""
    n = len(values)
    size = -(-n // width) * width
    padded = np.full(size, MASK, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    m = n - width + 1
    return np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])


def territories(
    data: np.ndarray, bounds: np.ndarray, length: int, name: int
) -> tuple[np.ndarray, ...]:
    """Runs of windows that have the same sampled suffix.

    ``data`` holds texts one after the other, ``bounds`` their offsets (one more than texts).
    A window is a string of ``length`` bytes within one text.  Its sampled suffix is the one,
    among those that start in it with ``name`` bytes left in it, whose name (hash of the first
    ``name`` bytes) is least, the leftmost of equals.  The choice depends on the window's bytes
    only, so equal windows choose alike.  Returns text number, first and last window start,
    start of the sampled suffix (all relative to ``data``), name hash and hash of the whole
    string the run covers.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hasher = Hasher(data, BASES[0])
    names = hasher.every(name)
    index = np.arange(len(names), dtype=np.uint64)
    keys = (names >> INDEX_BITS << INDEX_BITS) | index
    chosen = (sliding_min(keys, length - name + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    starts = len(data) - length + 1
    edge = np.zeros(starts + 1, dtype=bool)
    edge[0] = edge[-1] = True
    np.not_equal(chosen[1:], chosen[:-1], out=edge[1:-1])
    inner = bounds[1:-1]
    edge[inner[inner < starts]] = True  # a text begins
    last = np.maximum(inner - length + 1, 0)
    edge[last[last < starts]] = True  # from here on windows reach into the next text
    cuts = np.flatnonzero(edge)
    first, end = cuts[:-1], cuts[1:] - 1
    text = np.searchsorted(bounds, first, side="right") - 1
    whole = end + length <= bounds[text + 1]
    first, end, text = first[whole], end[whole], text[whole]
    block = Hasher(data, BASES[1]).at(first, end + length)
    anchor = chosen[first]
    return text, first, end, anchor, names[anchor], block
