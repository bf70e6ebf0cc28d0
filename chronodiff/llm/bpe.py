"""Byte-level BPE with a public vocabulary, without a regular expression (problem 7).

Pre-tokenisation: every code point of a batch gets a class; each class is a transition function of a small automaton,
the functions are composed by an associative scan over blocks, and the states so found tell where pieces begin. Each
distinct piece is merged once and kept in a cache; offsets of the pieces are retained.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Classes of code points: letter, number, other, space before a visible character, other blank before one, blank before
# a blank or the end, and an apostrophe that opens a contraction of one or two letters.
L, N, O, SPACE, BLANK, BLANKS, APOS1, APOS2 = range(8)
# States: nothing open, letters, numbers, others, a space to be taken along, blanks, one or two letters of a contraction to come.
NONE, IN_L, IN_N, IN_O, HELD, IN_B, NEED1, NEED2 = range(8)
STATES = 8
# White space, and what contractions go on with.
WHITE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")
_MAX = sys.maxunicode + 1


@lru_cache(1)
def code_classes() -> np.ndarray:
    """Class of each code point: L, N, BLANKS or O."""
    kinds = {"L": L, "N": N}
    table = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], O) for i in range(_MAX)), np.uint8, _MAX)
    table[WHITE] = BLANKS
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins at this character."""
    if state == NEED1:
        return NONE, False
    if state == NEED2:
        return NEED1, False
    if symbol in (L, N, O):
        inside = (IN_L, IN_N, IN_O)[symbol]
        return inside, state not in (inside, HELD)
    if symbol == SPACE:
        return HELD, True
    if symbol == BLANK:
        return NONE, True
    if symbol == BLANKS:
        return IN_B, state != IN_B
    if state in (IN_O, HELD):
        return IN_O, False
    return (NEED1 if symbol == APOS1 else NEED2), True


# NEXT[symbol, state], BEGINS[symbol, state]; a symbol + 8 is the same at the start of a text, whatever came before.
NEXT = np.array([[_step(s, x)[0] for s in range(STATES)] for x in range(8)] + [[_step(NONE, x)[0]] * STATES for x in range(8)], np.uint8)
BEGINS = np.array([[_step(s, x)[1] for s in range(STATES)] for x in range(8)] + [[True] * STATES for _ in range(8)], bool)


def symbols(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbols of the code points of texts laid end to end; ``starts``: where each text that isn't empty begins."""
    n = len(codes)
    s = code_classes()[codes]
    first = np.zeros(n + 2, bool)
    first[starts] = True
    first[n:] = True
    blank = s == BLANKS
    visible_next = np.zeros(n, bool)
    visible_next[:-1] = ~blank[1:]
    visible_next &= ~first[1 : n + 1]
    out = s.copy()
    out[blank & visible_next] = BLANK
    out[(codes == 0x20) & visible_next] = SPACE
    at = np.flatnonzero(codes == 0x27)
    if len(at):
        pad = np.concatenate([codes, np.zeros(2, codes.dtype)])
        a, b = pad[at + 1], pad[at + 2]
        in1 = ~first[at + 1]
        in2 = in1 & ~first[np.minimum(at + 2, n)]
        two = np.zeros(len(at), bool)
        for w in TWO_LETTERS:
            two |= (a == ord(w[0])) & (b == ord(w[1]))
        one = np.isin(a, [ord(c) for c in ONE_LETTER]) & in1
        out[at[two & in2]] = APOS2
        out[at[one]] = APOS1
    out[first[:n]] += 8
    return out


def states_before(sym: np.ndarray, block: int = 128) -> np.ndarray:
    """State before each character: transition functions are composed inside blocks, then across blocks by doubling."""
    n = len(sym)
    rows = -(-n // block)
    padded = np.full(rows * block, O, np.uint8)
    padded[:n] = sym
    grid = padded.reshape(rows, block)
    f = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (rows, STATES)).copy()
    for j in range(block):
        f = NEXT[grid[:, j, None], f]
    step = 1
    while step < rows:
        f[step:] = np.take_along_axis(f[step:], f[:-step].copy(), axis=1)
        step *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = f[:-1, NONE]
    out = np.empty((rows, block), np.uint8)
    for j in range(block):
        out[:, j] = state
        state = NEXT[grid[:, j], state]
    return out.reshape(-1)[:n]


def piece_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts laid end to end, where each piece begins in that, and where each text begins."""
    joined = "".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    if not joined:
        return joined, np.zeros(0, np.int64), begin
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = symbols(codes, begin[:-1][sizes > 0])
    return joined, np.flatnonzero(BEGINS[sym, states_before(sym)]), begin


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Ids of texts by the ranks of a byte-level BPE. Pieces up to ``keep_chars`` long are cached, at most ``cache`` of them."""

    def __init__(self, ranks: dict[bytes, int], cache: int = 500_000, keep_chars: int = 64):
        self.ranks, self.most, self.keep = ranks, cache, keep_chars
        self.cache: dict[str, list[int]] = {}
        self.sizes: np.ndarray | None = None

    def merge(self, data: bytes) -> list[int]:
        """Merges the neighbours of the lowest rank, leftmost first, until none is left; n log n in the bytes."""
        ranks = self.ranks
        if (r := ranks.get(data)) is not None:
            return [r]
        n = len(data)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        part: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            if part[i] is None or (j := nxt[i]) >= n or len(part[i]) + len(part[j]) != size:
                continue
            part[i] += part[j]
            part[j] = None
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if (r := ranks.get(part[i] + part[k])) is not None:
                    heapq.heappush(heap, (r, i, len(part[i]) + len(part[k])))
            if (h := prv[i]) >= 0 and (r := ranks.get(part[h] + part[i])) is not None:
                heapq.heappush(heap, (r, h, len(part[h]) + len(part[i])))
        return [ranks[p] for p in part if p is not None]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """How many bytes each id stands for."""
        if self.sizes is None:
            self.sizes = np.zeros(max(self.ranks.values()) + 1, np.int64)
            self.sizes[list(self.ranks.values())] = [len(b) for b in self.ranks]
        return self.sizes[ids]

    def piece(self, s: str) -> list[int]:
        ids = self.cache.get(s)
        if ids is None:
            ids = self.merge(s.encode("utf-8", "replace"))
            if len(s) <= self.keep:
                if len(self.cache) >= self.most:
                    self.cache.clear()
                self.cache[s] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        """All ids one after the other, and the offset of each text's ids among them (one more than texts)."""
        joined, starts, begin = piece_starts(texts)
        cuts = starts.tolist()
        cuts.append(len(joined))
        ids: list[int] = []
        counts = np.empty(len(cuts), np.int64)
        get, piece = self.cache.get, self.piece
        a = 0
        for i, b in enumerate(cuts[1:] if starts.size else []):
            s = joined[a:b]
            ids += get(s) or piece(s)
            counts[i] = len(ids)
            a = b
        ends = np.concatenate([[0], counts[: len(starts)]])
        return ids, ends[np.searchsorted(starts, begin)]

    def encode_block(self, texts: list[str], size: int) -> tuple[list[int], np.ndarray]:
        """As :meth:`encode`; a single text longer than twice ``size`` goes in parts, so that memory doesn't follow its length."""
        if len(texts) != 1 or len(texts[0]) <= 2 * size:
            return self.encode(texts)
        ids = [i for p in parts(texts[0], size) for i in self.encode([p])[0]]
        return ids, np.array([0, len(ids)])


def parts(text: str, size: int) -> Iterator[str]:
    """The text cut where pieces begin, into parts of about ``size`` characters; pieces of the parts are those of the text.

    What begins a piece is decided by the characters before it and the two behind it, so the last few of a look aren't
    trusted; nor is a cut behind a blank, as blanks at an end are one piece. A look without a usable start is taken longer.
    """
    a, look = 0, size
    while len(text) - a > look:
        starts = piece_starts([text[a : a + look]])[1]
        cut = next((c for c in starts[: np.searchsorted(starts, look - 3)][::-1].tolist() if c == 0 or code_classes()[ord(text[a + c - 1])] != BLANKS), 0)
        if cut:
            yield text[a : a + cut]
            a, look = a + cut, size
        else:
            look *= 2
    yield text[a:]


def decode(ids: list[int], words: dict[int, bytes]) -> str:
    return b"".join(words[i] for i in ids).decode("utf-8", "replace")
