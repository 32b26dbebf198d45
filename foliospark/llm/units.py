"""Token ids of whole texts by way of their distinct units.

A unit is a byte range of a text that a tokenizer encodes by itself: a run of white space with the word after it, or a word, or
a part of one. A text's ids are those of its units in order, so each distinct unit is encoded once while it stays in the cache.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from foliospark.llm.textbytes import Texts


class HashIndex:
    """Open-addressing table from well-mixed 64-bit hashes to whole numbers from 0, probed for whole arrays at once."""

    def __init__(self, bits: int = 16):
        self.used = 0
        self._make(bits)

    def _make(self, bits: int) -> None:
        self.bits = bits
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where there is none."""
        slot = self._slot(h)
        out = self.values[slot]
        todo = np.flatnonzero((self.keys[slot] != h) & (out >= 0))
        while len(todo):
            at = (slot[todo] + 1) & ((1 << self.bits) - 1)
            slot[todo] = at
            out[todo] = held = self.values[at]
            todo = todo[(self.keys[at] != h[todo]) & (held >= 0)]
        return out

    def add(self, h: np.ndarray, values: np.ndarray) -> None:
        """Distinct hashes that the table doesn't hold yet."""
        self.used += len(h)
        if 2 * self.used > 1 << self.bits:
            old = self.values >= 0
            h, values = np.r_[self.keys[old], h], np.r_[self.values[old], values]
            self._make(int(2 * self.used).bit_length() + 1)
        slot = self._slot(h)
        while len(h):
            free = np.flatnonzero(self.values[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            win = free[first]
            self.keys[slot[win]], self.values[slot[win]] = h[win], values[win]
            rest = np.ones(len(h), bool)
            rest[win] = False
            h, values, slot = h[rest], values[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)


class UnitCache:
    """Ids of units by their 64-bit hash. It starts anew when it holds `most` units, so its memory is bounded; results don't depend on it.

    encode(units, kinds) gives the ids of all units in one array and how many each has.
    """

    def __init__(self, encode: Callable[[list[bytes], np.ndarray], tuple[np.ndarray, np.ndarray]], most: int = 400_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.index, self.n, self.used = HashIndex(), 0, 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.starts, self.lens = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def _add(self, hashes: np.ndarray, flat: np.ndarray, lens: np.ndarray) -> None:
        if self.used + len(flat) > len(self.flat):
            self.flat = np.r_[self.flat[: self.used], np.zeros(max(len(flat), self.used), np.int32)]
        if self.n + len(lens) > len(self.starts):
            grow = max(len(lens), self.n)
            self.starts, self.lens = np.r_[self.starts[: self.n], np.zeros(grow, np.int64)], np.r_[self.lens[: self.n], np.zeros(grow, np.int32)]
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[self.n : self.n + len(lens)] = self.used + np.cumsum(lens) - lens
        self.lens[self.n : self.n + len(lens)] = lens
        self.index.add(hashes, np.arange(self.n, self.n + len(lens), dtype=np.int32))
        self.used, self.n = self.used + len(flat), self.n + len(lens)

    def ids(self, t: Texts, start: np.ndarray, end: np.ndarray, doc: np.ndarray, kind: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text) for units [start, end) of the texts `doc`; kind goes to encode."""
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(t.n, np.int64)
        hashes = t.hashes(start, end)
        where = self.index.find(hashes)
        new = np.flatnonzero(where < 0)
        if len(new):
            keys, first = np.unique(hashes[new], return_index=True)
            if self.n + len(keys) > self.most and self.n:
                self._clear()
                new = np.arange(len(hashes))
                keys, first = np.unique(hashes, return_index=True)
            at = new[first]
            raw = t.data.tobytes()
            units = [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
            self._add(keys, *self.encode(units, kind[at] if kind is not None else np.zeros(len(at), bool)))
            where = self.index.find(hashes)
        lens = self.lens[where]
        ends = np.cumsum(lens, dtype=np.int64)
        take = np.arange(ends[-1])
        take += np.repeat(self.starts[where] - (ends - lens), lens)
        return self.flat[take], np.bincount(doc, weights=lens, minlength=t.n).astype(np.int64)


def words_with_space(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of all units: each word with the white space before it, and white space that ends a text."""
    start = np.r_[0, t.end[:-1]] if len(t.end) else t.start.copy()
    heads = t.first_word[:-1][t.n_words > 0]
    start[heads] = t.offsets[:-1][t.n_words > 0]
    last = t.offsets[:-1].copy()
    last[t.n_words > 0] = t.end[t.first_word[1:][t.n_words > 0] - 1]
    tails = np.flatnonzero(last < t.offsets[1:])
    if not len(tails):
        return start, t.end, t.doc
    place = t.first_word[tails + 1]
    return np.insert(start, place, last[tails]), np.insert(t.end, place, t.offsets[1:][tails]), np.insert(t.doc, place, tails)
