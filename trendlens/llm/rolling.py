"""Vectorised 64-bit polynomial hashes of substrings, by differences of prefix sums."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to n."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 2 * len(_POWERS[0]))
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the bytes times the powers; entry i covers the bytes before i."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def string_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans, mixed eight bytes at a time: unlike a polynomial, not additive in the bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), 0, (1,))  # the eight bytes from every offset
    out = mix((end - start).astype(np.uint64) + np.uint64(BASE))
    rest, at = np.arange(len(start)), start
    while len(rest):
        left = end[rest] - at
        part = eight[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
        out[rest] = mix((out[rest] ^ part) * np.uint64(BASE) + (part >> np.uint64(29)))
        more = left > 8
        rest, at = rest[more], at[more] + 8
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
