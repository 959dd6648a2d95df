"""SHA-256 states that can be kept, copied and resumed, for many messages at once.

``hashlib`` can copy a state within one process but not store it.  Here a state is eight 32-bit words, so a
state between blocks is 32 bytes that a table can hold.  A digest as hex text is 64 bytes, which is one
block: a node's state before child slot i is its state after i blocks.  Arrays are (words, messages).
"""

from __future__ import annotations

import math

import numpy as np


def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle ** 3 <= n else (low, middle - 1)
    return low


# The standard's constants: fractions of the square and cube roots of the first primes.
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)[:, None]
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
_HALVES = np.arange(1 << 16)
# The four hex digits of 16 bits, as one big-endian word.
_HEX = sum(
    np.frombuffer(b"0123456789abcdef", np.uint8).astype(np.uint32)[_HALVES >> (4 * i) & 15] << np.uint32(8 * i)
    for i in range(4)
).astype(np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return x >> np.uint32(n) | x << np.uint32(32 - n)


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block of 16 words each."""
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ x >> np.uint32(3)) + w[i - 7]
                     + (_turn(y, 17) ^ _turn(y, 19) ^ y >> np.uint32(10)))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ e & (f ^ g)) + (w[i] + _ROUND[i])
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + (a & b | c & (a | b))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack(np.broadcast_arrays(a, b, c, d, e, f, g, h))


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The block that a digest is as hex text."""
    halves = np.empty((16, digests.shape[1]), np.uint32)
    halves[0::2] = _HEX[digests >> np.uint32(16)]
    halves[1::2] = _HEX[digests & np.uint32(0xFFFF)]
    return halves


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages that end after so many blocks."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    bits = blocks.astype(np.uint64) * np.uint64(512)
    last[0] = 0x80000000
    last[14], last[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return absorb(state, last)


def starts(n: int) -> np.ndarray:
    return np.repeat(START, n, axis=1)


def from_bytes(data: bytes) -> np.ndarray:
    """Digests or states of 32 bytes each, one after another."""
    return np.ascontiguousarray(np.frombuffer(data, ">u4").astype(np.uint32).reshape(-1, 8).T)


def to_bytes(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words.T).astype(">u4").tobytes()


def to_hex(words: np.ndarray) -> list[str]:
    text = to_bytes(words).hex()
    return [text[i:i + 64] for i in range(0, len(text), 64)]
