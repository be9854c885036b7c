"""Word boundaries and 64-bit word hashes for a slice of texts, as NumPy array work.

A polynomial hash in wrapping 64-bit arithmetic: prefix sums of byte * P^i give
every word's hash as one difference, shifted back by P^-start and then mixed.
Such a hash collides by construction on long words of a certain pattern, so words
over ``LONG`` bytes get xxh3 of their bytes instead. The sums run over windows of
whole words, so a long text costs no more memory for them than a short one.
"""

from __future__ import annotations

import numpy as np
import xxhash

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))

#: Bytes of the longest word that the polynomial hashes, and of a window of words hashed at once (about).
LONG = 64
WINDOW = 2 << 20

#: [^\x20\x09-\x0D]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: ASCII letters and digits and all bytes of multi-byte characters
ALNUM = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    ALNUM[_a:_b] = True
#: A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Keeps the powers of P, grown to the longest slice seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            m = max(n + 1, 1 << 16)
            for name, p in (("up", _P), ("down", _P_INV)):
                a = np.full(m, p, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a))

    def spans(self, data: np.ndarray, offs: np.ndarray, word: np.ndarray = NOT_SPACE):
        """``(starts, ends, doc)`` of the words; words never cross a text's edge."""
        n = len(data)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, z
        w = word[data]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        s = w.copy()
        s[1:] &= ~w[:-1] | edge[1:n]
        e = w.copy()
        e[:-1] &= ~w[1:] | edge[1:n]
        starts, ends = np.flatnonzero(s), np.flatnonzero(e) + 1
        return starts, ends, np.searchsorted(offs, starts, "right") - 1

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash per ``data[start:end]``; the words lie in order."""
        out = np.zeros(len(starts), np.uint64)
        size = ends - starts
        short = np.flatnonzero(size <= LONG)
        lo = 0
        while lo < len(short):
            first = int(starts[short[lo]])
            hi = lo + int(np.searchsorted(ends[short[lo:]], first + WINDOW, "right"))
            at = short[lo:max(hi, lo + 1)]
            out[at] = self._polynomial(data[first:int(ends[at[-1]])], starts[at] - first, ends[at] - first)
            lo += len(at)
        for n in np.flatnonzero(size > LONG).tolist():
            out[n] = xxhash.xxh3_64_intdigest(data[starts[n]:ends[n]])
        return out

    def _polynomial(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        self._powers(n)
        pre = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=pre[1:])
        return mix((pre[ends] - pre[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def combine(*parts: np.ndarray) -> np.ndarray:
    """Order-dependent hash of equally long hash arrays."""
    h = np.full(len(parts[0]), 0x243F6A8885A308D3 + len(parts), np.uint64)
    for p in parts:
        h = mix(h * _P + p)
    return h
