"""Hashes of all substrings of one length, and the anchors that cut a text into units by its content alone."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Odd multipliers modulo 2^64 and seeds of the tables that spread the code points; fixed so that all machines agree.
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
SEEDS = (0x51ED270B9B1F4E3D, 0x2545F4914F6CDD1D)
#: Windows that are handled at once; longer texts are cut into overlapping chunks.
CHUNK = 400_000
_LAST = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(4)
def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base, and of its inverse."""
    base = BASES[which]
    inverse = pow(base, -1, 2**64)
    one = np.ones(n + 1, np.uint64)
    a, b = one.copy(), one.copy()
    a[1:], b[1:] = np.uint64(base), np.uint64(inverse)
    return np.multiply.accumulate(a), np.multiply.accumulate(b)


class Hashes:
    """Polynomial hashes of any substrings of one text: two of 64 bits, each over code points spread by an own table."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        size = max(2 * CHUNK, 1 << (n + 1).bit_length())
        self.prefix, self.inverse = [], []
        for w in range(2):
            up, down = powers(w, size)
            spread = mix(codes.astype(np.uint64) + np.uint64(SEEDS[w]))
            p = np.zeros(n + 1, np.uint64)
            np.cumsum(spread * up[:n], out=p[1:])
            self.prefix.append(p)
            self.inverse.append(down)

    def of(self, which: int, start: np.ndarray, length) -> np.ndarray:
        p = self.prefix[which]
        return mix((p[start + length] - p[start]) * self.inverse[which][start] + np.uint64(1) * np.asarray(length, np.uint64))

    def all_of(self, which: int, length: int) -> np.ndarray:
        p = self.prefix[which]
        return mix((p[length:] - p[:-length]) * self.inverse[which][: len(p) - length] + np.uint64(length))


def sliding_argmin(v: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each window of ``width`` values, by doubling."""
    at = np.arange(len(v), dtype=np.int64)
    span = 1
    while span < width:
        s = min(span, width - span)
        right = v[s:]
        left = v[: len(right)]
        less = right < left
        at = np.where(less, at[s:], at[: len(right)])
        v = np.where(less, right, left)
        span += s
    return at


def chunks(keys: list, texts: list[str], length: int, size: int = CHUNK) -> Iterator[tuple[list, np.ndarray, np.ndarray, str]]:
    """(keys, offsets in their texts, starts, text) of about ``size`` windows each; texts shorter than a window are left out.

    Parts of a long text overlap by ``length - 1`` characters, so that each window lies in exactly one part.
    """
    ks, offs, parts, total = [], [], [], 0

    def out():
        begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return ks, np.array(offs, np.int64), begin, "".join(parts)

    for k, t in zip(keys, texts):
        for a in range(0, len(t) - length + 1, size):
            p = t[a : a + size + length - 1]
            if total and total + len(p) > size + length:
                yield out()
                ks, offs, parts, total = [], [], [], 0
            ks.append(k)
            offs.append(a)
            parts.append(p)
            total += len(p)
    if parts:
        yield out()


def units(begin: np.ndarray, text: str, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(part, first, n, anchor, digest1, digest2) of the units of texts laid end to end.

    Each window of ``length`` characters has the anchor that is the leftmost smallest of the hashed grams in it; a unit
    is a run of consecutive windows with one anchor. Both depend on the window's characters alone, so equal windows in
    different texts have equal anchors, whatever surrounds them.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = Hashes(codes)
    g = h.all_of(0, gram)
    cut = np.zeros(len(codes) + 1, np.int64)
    cut[begin[1:]] = 1
    part_of = np.cumsum(cut)[:-1]
    ends = begin[1:][part_of]
    pos = np.arange(len(codes))
    g = np.where(pos[: len(g)] + gram <= ends[: len(g)], g, _LAST)
    at = sliding_argmin(g, length - gram + 1)
    w = np.flatnonzero(pos[: len(at)] + length <= ends[: len(at)])
    a = at[w]
    new = np.ones(len(w), bool)
    new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1] + 1)
    i = np.flatnonzero(new)
    first = w[i]
    n = np.diff(np.append(i, len(w)))
    size = n + length - 1
    return part_of[first], first - begin[part_of[first]], n, g[a[i]], h.of(0, first, size), h.of(1, first, size)
