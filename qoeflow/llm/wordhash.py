"""Words of a text and 64-bit hashes of word sequences, computed by array steps.

Words are runs of characters other than ASCII white space, ASCII letters in lower case. A sequence's
hash is a polynomial in its words' hashes modulo 2**64 (odd bases, so powers have inverses), mixed at
the end; equal sequences have equal hashes, wherever they stand.
"""

from __future__ import annotations

import numpy as np

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1


class _Powers:
    """Powers of an odd base and of its inverse, as far as they are needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base & _MASK, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word in UTF-8 bytes."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def encoded(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    up, down = _BYTES.to(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    raw = encoded(text)
    starts, ends = word_bounds(raw)
    return span_hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.to(len(hashes) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)))
    return mix((sums[k:] - sums[:n]) * down[:n])


def shingles(text: str | None, k: int) -> np.ndarray:
    """The set of hashes of k-word sequences; of all words where there are fewer, but not none."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    return np.unique(gram_hashes(hashes, min(k, len(hashes))))
