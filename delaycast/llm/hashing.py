"""Hashes of many words, or of all substrings of a length, at once."""

from __future__ import annotations

import functools

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_values = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Texts are hashed together up to this many bytes.
TOGETHER = 1 << 20


@functools.lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, dtype=np.uint64), np.full(size, INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n - 1 or more, modulo 2 ** 64."""
    return _powers(max(TOGETHER, 1 << (n - 1).bit_length()) if n > 1 else TOGETHER)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sums:
    """Hashes of any substrings of a byte string, from running sums."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.empty(len(raw) + 1, dtype=np.uint64)
        self.sums[0] = 0
        np.cumsum(_values[raw] * up[: len(raw)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def all(self, size: int) -> np.ndarray:
        """Of each substring of `size` bytes."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])
