"""Pre-tokens of byte-level BPE, vectorised, and a cache of the ids of each.

The cuts are those of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``, found from
runs of one character class: a space joins the run after it, other white space before a run stands alone,
and an apostrophe alone before a listed suffix takes that suffix.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa

from vacantia.llm import _text as T

SPACE, LETTER, NUMBER, OTHER = range(4)


@cache
def char_classes() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    for low, high in ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        table[low : high + 1] = SPACE
    return table


def starts_of(cp: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each code point; edge is true where a row begins."""
    n = len(cp)
    kind = char_classes()[cp]
    run = np.ones(n, bool)
    run[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
    out = run.copy()
    after = np.flatnonzero(run & (kind != SPACE) & ~edge[:n])
    after = after[kind[after - 1] == SPACE]
    out[after - 1] = True
    out[after[cp[after - 1] == 32]] = False
    quote = np.flatnonzero((cp == 39) & out)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~edge[quote + 1]]
    if len(quote):
        one = cp[quote + 1]
        two = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], cp[np.minimum(quote + 2, n - 1)], 0)
        k = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        k[(one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))] = 2
        quote, k = quote[k > 0], k[k > 0]
        out[quote + 1] = False
        rest = quote + 1 + k
        rest = rest[rest < n]
        rest = rest[(kind[rest] == LETTER) & ~edge[rest]]
        out[rest] = True
    return out


class WordIds:
    """Ids of words by their 64-bit hash, in an open table; emptied when it is full."""

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]], words: int):
        self.encode_words, self.bits = encode, max(10, int(words * 1.4).bit_length())
        self.limit = words
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.slot = np.zeros(1 << self.bits, np.int32)
        self.n, self.used = 0, 0
        self.offset, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, np.uint32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The index of each hash, -1 where it isn't known."""
        out = np.full(len(h), -1, np.int64)
        mask = (1 << self.bits) - 1
        open_, at = np.arange(len(h)), (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(open_):
            here = self.keys[at]
            hit = here == h[open_]
            out[open_[hit]] = self.slot[at[hit]]
            on = ~hit & (here != 0)
            open_, at = open_[on], (at[on] + 1) & mask
        return out

    def add(self, h: np.ndarray, ids: list[np.ndarray]) -> None:
        """New hashes, each once."""
        sizes = np.array([len(x) for x in ids], np.int32)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        while self.n + len(h) > len(self.offset):
            self.offset, self.size = np.resize(self.offset, 2 * len(self.offset)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.offset[self.n : self.n + len(h)] = self.used + np.cumsum(sizes) - sizes
        self.size[self.n : self.n + len(h)] = sizes
        self.flat[self.used : self.used + len(flat)] = flat
        mask = (1 << self.bits) - 1
        open_, at = np.arange(len(h)), (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(open_):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[open_[free]]
            won = self.keys[at] == h[open_]
            self.slot[at[won]] = self.n + open_[won]
            open_, at = open_[~won], (at[~won] + 1) & mask
        self.n += len(h)
        self.used += len(flat)


def _cut(data: np.ndarray, offsets: np.ndarray, added: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets of the segments that added tokens leave, and for each the added token's id or -1."""
    text = data.tobytes()
    if not any(t.encode() in text for t in added):
        return offsets, np.full(len(offsets) - 1, -1), np.arange(len(offsets))
    pattern = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(added, key=len, reverse=True)))
    cuts, ids, first = [], [], [0]
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        at = low
        for m in pattern.finditer(text, low, high):
            if m.start() > at:
                cuts.append(at)
                ids.append(-1)
            cuts.append(m.start())
            ids.append(added[m[0].decode()])
            at = m.end()
        if at < high:
            cuts.append(at)
            ids.append(-1)
        first.append(len(cuts))
    return np.array([*cuts, len(data)], np.int64), np.array(ids, np.int64), np.array(first)


def encode(texts: pa.Array, words: WordIds, added: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows back to back, and the offsets of the rows."""
    data, offsets = T.utf8(texts)
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
    cuts, special, first = _cut(data, offsets, added)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    where = np.flatnonzero((data & 0xC0) != 0x80)  # the byte of each code point
    edge = np.zeros(len(cp) + 1, bool)
    edge[np.searchsorted(where, cuts)] = True
    begin = where[np.flatnonzero(starts_of(cp, edge))]
    marked = np.flatnonzero(special >= 0)
    if len(marked):  # an added token is one word
        inside = np.zeros(len(data) + 1, np.int64)
        np.add.at(inside, cuts[marked] + 1, 1)
        np.add.at(inside, cuts[marked + 1], -1)
        begin = begin[np.cumsum(inside)[begin] == 0]
    end = np.append(begin[1:], len(data))
    h = T.span_hashes(T.prefix_sums(T.BYTE_VALUES[data]), begin, end) | np.uint64(1)
    if words.n + len(h) > words.limit:
        words.clear()
    at = words.find(h)
    if len(missing := np.flatnonzero(at < 0)):
        new, one = np.unique(h[missing], return_index=True)
        one = missing[one]
        text = data.tobytes()
        plain = [text[s:e] for s, e in zip(begin[one].tolist(), end[one].tolist())]
        words.add(new, words.encode_words(plain))
        at[missing] = words.find(h[missing])
    sizes = words.size[at].astype(np.int64)
    ids = words.flat[T.ranges(words.offset[at], sizes)]
    if len(marked):
        place = np.searchsorted(begin, cuts[marked])
        keep = np.ones(len(at), bool)
        keep[place] = False
        out_sizes = np.where(keep, sizes, 1)
        starts = np.cumsum(out_sizes) - out_sizes
        merged = np.zeros(int(out_sizes.sum()), np.uint32)
        merged[T.ranges(starts[keep], sizes[keep])] = words.flat[T.ranges(words.offset[at[keep]], sizes[keep])]
        merged[starts[place]] = special[marked]
        ids, sizes = merged, out_sizes
    total = np.concatenate([[0], np.cumsum(sizes)])
    return ids, total[np.searchsorted(begin, offsets)]
