"""Prefix polynomial hashes of byte strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd bases of the polynomials, modulo 2**64.
BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
#: Bytes hashed at once; a longer text is hashed alone.
CHUNK = 1 << 19

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(max(n, CHUNK + 1), b, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


class Hashes:
    """Prefix hashes of a byte string; any substring's hash in two reads."""

    def __init__(self, text: np.ndarray, base: int = BASES[0]):
        up, self.down = powers(len(text) + 1, base)
        self.prefix = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.prefix[1:])

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.down[at]

    def every(self, length: int) -> np.ndarray:
        n = len(self.prefix) - length
        return (self.prefix[length:] - self.prefix[:n]) * self.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xD6E8FEB86659FD93)


def batches_of(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` bytes together."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > CHUNK:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)
