"""Words and their 64-bit hashes, computed for many texts at once on their UTF-8 bytes.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z: digits,
a-z and every non-ASCII character.  All bytes of a non-ASCII character are 0x80 or more,
so the class can be tested byte by byte.
"""

from __future__ import annotations

import numpy as np

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept per process and grown on demand."""
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        size = max(1 << 20, 1 << (n - 1).bit_length())
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers[key][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of the result depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte span, whatever its place in ``data``."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts])


class Words:
    """The words of some texts: byte spans, hashes, and the range of each text's words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        inside = IN_WORD[self.data]
        before = np.empty_like(inside)
        before[1:], after = inside[:-1], np.empty_like(inside)
        after[:-1] = inside[1:]
        full = offsets[:-1][np.diff(offsets) > 0]
        ends = offsets[1:][np.diff(offsets) > 0]
        before[full] = False
        after[ends - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        #: words of text i: at[i] .. at[i + 1]
        self.at = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def list(self, i: int, j: int) -> list[bytes]:
        """The words i .. j as bytes."""
        if i >= j:
            return []
        base = int(self.starts[i])
        raw = self.data[base : int(self.ends[j - 1])].tobytes()
        return [raw[a:b] for a, b in zip((self.starts[i:j] - base).tolist(), (self.ends[i:j] - base).tolist())]

    def grams(self, k: int) -> np.ndarray:
        """The hash of words i .. i + k for every i, also across texts (see ``fits``)."""
        n = max(0, len(self) - k + 1)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h *= np.uint64(0xD6E8FEB86659FD93)
            h += self.hashes[j : j + n]
        return mix(h)

    def fits(self, k: int) -> np.ndarray:
        """Whether words i .. i + k are of one text."""
        n = max(0, len(self) - k + 1)
        end = np.repeat(self.at[1:], np.diff(self.at))[:n]
        return np.arange(k, n + k) <= end
