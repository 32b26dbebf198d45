"""Words, lines and 64-bit hashes of whole Arrow text columns, taken from their UTF-8 bytes with numpy.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Those separators are ASCII, so no word splits a code point.
Hashes are polynomials modulo 2**64 over random byte codes, then mixed; equal bytes give equal hashes in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.Generator(np.random.PCG64(20240229))
CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15 - 0x9E3779B97F4A7C15 % 8 + 5  # 5 modulo 8: powers have the longest period
BASE_INVERSE = pow(BASE, -1, 2**64)
WINDOW_CODES = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(18, n.bit_length())
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE, np.uint64)], dtype=np.uint64)
            _inverses = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE_INVERSE, np.uint64)], dtype=np.uint64)
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit words over all others."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(32))


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving the memory that its arrays took back to the system after a task's last row: Python workers live on for other tasks."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # a C library without it
            pass

    return whole


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts of at most `most` bytes, or of one longer text. A null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Texts:
    """The texts of one slice: .start and .end of each word, .doc (its text), and hashes of any byte ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets, self.n = (LOWER[data] if lower else data), offsets, len(offsets) - 1
        self._sums: np.ndarray | None = None
        inside = ~IS_SEPARATOR[self.data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.r_[False, inside[:-1]] if len(data) else inside
        self.start = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.r_[inside[1:], False] if len(data) else inside
        self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.first_word = np.searchsorted(self.start, offsets)  # of each text, and the count at the end
        self.n_words = np.diff(self.first_word)
        self.doc = np.repeat(np.arange(self.n), self.n_words)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges; an empty range has the hash of empty."""
        powers, inverses = _power_tables(len(self.data) + 1)
        with np.errstate(over="ignore"):
            if self._sums is None:
                self._sums = np.zeros(len(self.data) + 1, np.uint64)
                np.cumsum(CODES[self.data] * powers[: len(self.data)], out=self._sums[1:])
            return mix((self._sums[end] - self._sums[start]) * inverses[start] + (end - start).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)

    def counts(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        sums = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` values, by its first position; callers drop runs that cross two texts."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out += h[k : k + n] * WINDOW_CODES[k]
    return mix(out)


def shingles(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text of each) of all word shingles; a text with fewer words has its whole word sequence as the only one."""
    h = texts.word_hashes()
    runs = windows(h, width)
    doc = texts.doc
    whole = doc[: len(runs)] == doc[width - 1 :] if len(runs) else np.zeros(0, bool)
    out, of = runs[whole], doc[: len(runs)][whole]
    short = np.flatnonzero((texts.n_words > 0) & (texts.n_words < width))
    if len(short):
        extra = []
        with np.errstate(over="ignore"):
            for d in short:
                part = h[texts.first_word[d] : texts.first_word[d + 1]]
                extra.append((part * WINDOW_CODES[: len(part)]).sum(dtype=np.uint64) + np.uint64(len(part)) * WINDOW_CODES[63])
        out, of = np.r_[out, mix(np.array(extra, np.uint64))], np.r_[of, short]
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of
