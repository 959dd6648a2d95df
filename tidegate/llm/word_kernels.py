"""Array code that turns texts into hashes of words and of word shingles."""

from __future__ import annotations

import numpy as np

from tidegate.llm.suffix_kernels import BASES, Hasher, mixed

CHUNK = 2_000_000  # bytes hashed at once
FACTORS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes between words: space and the control characters from tab to carriage return.
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Every ASCII byte that is neither letter nor digit.
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def word_hashes(texts: list[bytes], between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, number of its text), in order."""
    data = LOWER[np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)]
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    inside = ~between[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.empty(len(start), dtype=np.uint64)
    first = 0
    while first < len(start):
        base = start[first]
        last = max(first + 1, int(np.searchsorted(end, base + CHUNK, side="right")))
        part = Hasher(data[base : end[last - 1]], BASES[0])
        hashes[first:last] = part.at(start[first:last] - base, end[first:last] - base)
        first = last
    return hashes, np.searchsorted(bounds, start, side="right")


def shingles(words: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``n`` words within a text, number of its text)."""
    m = len(words) - n + 1
    if m <= 0:
        return words[:0], text[:0]
    whole = text[:m] == text[n - 1 :]
    total = np.full(m, n, dtype=np.uint64)
    for i in range(n):
        total += mixed(words[i : i + m] + np.uint64(FACTORS[i % 5])) * np.uint64(FACTORS[i % 5] + 2 * (i // 5))
    return mixed(total[whole]), text[:m][whole]


def by_text(values: np.ndarray, text: np.ndarray, n: int) -> list[np.ndarray]:
    """The distinct values of each of ``n`` texts, sorted."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return np.split(values, np.searchsorted(text, np.arange(1, n)))


def grouped(texts: list[bytes], size: int = CHUNK):
    """Slices of consecutive texts of about ``size`` bytes; a longer text is alone."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))
