"""Vectorised words of a batch of texts: bounds and 64-bit hashes without a Python object for each word."""

from __future__ import annotations

import numpy as np
import xxhash

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _inverse(x: int) -> int:
    """Of an odd number modulo 2**64 (Newton)."""
    y = x
    for _ in range(6):
        y = y * (2 - x * y) & (2**64 - 1)
    return y


class Powers:
    """BASE**i and BASE**-i modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            for name, base in (("up", int(BASE)), ("down", _inverse(int(BASE)))):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def scramble(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Longer words are hashed by XXH64: a polynomial modulo 2**64 can be fooled by long words of a special form (Thue-Morse words).
POLYNOMIAL_BYTES = 64
_VALUES = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Words:
    """Words of ``texts``: starts and ends in ``data``, word counts, and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join([b"", *texts, b""])
        raw = np.frombuffer(self.data, dtype=np.uint8)
        self.raw = raw
        white = _WHITE[raw]
        self.starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
        self.ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
        begins = np.cumsum(np.array([0, *map(len, texts)]) + 1)[:-1]
        self.first = np.searchsorted(self.starts, begins)
        self.counts = np.diff(np.append(self.first, len(self.starts)))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial over its bytes, scrambled with its length; XXH64 for long words."""
        up, down = POWERS.get(len(self.raw) + 1)
        sums = np.zeros(len(self.raw) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[self.raw] * up[: len(self.raw)], out=sums[1:])
        value = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        out = scramble(value + (self.ends - self.starts).astype(np.uint64))
        for i in np.flatnonzero(self.ends - self.starts > POLYNOMIAL_BYTES).tolist():
            out[i] = xxhash.xxh64_intdigest(self.data[self.starts[i] : self.ends[i]])
        return out


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries of ``h``."""
    if len(h) < n:
        return np.empty(0, dtype=np.uint64)
    up, down = POWERS.get(len(h) + 1)
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return scramble((sums[n:] - sums[:-n]) * down[: len(h) - n + 1])


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive entries, by doubling."""
    if len(x) < n:
        return x[:0]
    size, out = 1, x
    while size * 2 <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - size : n - size + len(x) - n + 1])
