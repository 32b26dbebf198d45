"""Byte-level BPE encoding and decoding with padded numpy matrices.

The distinct pieces of a batch are bucketed by length and laid out as matrix rows. Every round each row merges its leftmost
pair of minimum rank, found in a matrix of pair ranks that a hash table of pairs fills; then every row is one shorter, so the
matrix is compacted by one column. Rows without a mergeable pair leave the matrix. A piece of more than LONGEST bytes, for which a row
would need as many rounds as bytes, merges the same pairs in the same order by a heap.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.textbytes import Texts, freed, slices
from foliospark.llm.units import UnitCache, words_with_space
from foliospark.session import spread, table

BUCKETS = (4, 6, 8, 12, 16, 24, 32, 48, 64)  # then powers of two, up to LONGEST
DECODED_AT_ONCE = 1 << 18  # ids
LONGEST = 1024  # bytes of a matrix row
PIECES = 100_000  # whose ids a task keeps, at most
NO_RANK = np.int32(2**31 - 1)
CELLS = 1 << 18  # of one matrix at most, but for a single longer piece
#: White space that isn't ASCII, and controls that regular expressions count as white space: such texts are split as a whole.
OTHER_SPACE = regex.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class PairTable:
    """Open-addressing hash table from pairs of ids to the id of their merge, probed for whole arrays at once."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, np.int32)
        self.probes = 0
        slot = self._slot(keys)
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            win = free[first]
            self.keys[slot[win]], self.values[slot[win]] = keys[win], values[win]
            rest = np.ones(len(keys), bool)
            rest[win] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * self.MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        out = np.full(len(keys), NO_RANK, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        for _ in range(self.probes + 1):
            held = self.keys[slot]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            more = ~hit & (held >= 0)
            if not more.any():
                break
            todo, slot = todo[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out


class Vocabulary:
    """Merge ranks (bytes -> id) with their pair table, for encoding and decoding."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        table_ = np.array(pairs, np.int64).reshape(-1, 3)
        self.pairs = PairTable((table_[:, 0] << 32) | table_[:, 1], table_[:, 2].astype(np.int32))
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        self.token_lens = np.zeros(size, np.int64)
        self.by_id = by_id = [b""] * size
        for t, r in ranks.items():
            by_id[r] = t
            self.token_lens[r] = len(t)
        self.token_starts = np.cumsum(self.token_lens) - self.token_lens
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.pieces: dict[bytes, np.ndarray] = {}
        self.cache = UnitCache(self._encode_units, most=150_000)

    @classmethod
    @lru_cache(maxsize=2)
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merge_matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length, by merging all rows at once."""
        width = max(map(len, pieces))
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        out: list = [None] * len(pieces)
        row = np.arange(len(pieces))
        while True:
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(row)), at]
            else:
                at, best = np.zeros(len(row), np.int64), np.full(len(row), NO_RANK)
            open_ = best < NO_RANK
            for r in np.flatnonzero(~open_):
                out[row[r]] = ids[r, : lens[row[r]]].copy()
            if not open_.any():
                return out
            ids, ranks, row, at, best = ids[open_], ranks[open_], row[open_], at[open_], best[open_]
            n, width = ids.shape
            every = np.arange(n)
            ids[every, at] = best
            keep = np.ones((n, width), bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[every, at] = False
            ranks = ranks[keep].reshape(n, width - 2)
            lens[row] -= 1
            for side in (at - 1, at):  # the pairs beside the merged token
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[ok, side[ok]] = self.pairs.get(ids[ok, side[ok]], ids[ok, side[ok] + 1])

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: always its leftmost pair of minimum rank, kept in a heap."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        ranks = self.pairs.get(ids[:-1], ids[1:])
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(ranks[i]), int(i), int(i) + 1, ids[i], ids[i + 1]) for i in np.flatnonzero(ranks < NO_RANK)]
        heapq.heapify(heap)

        def look(i: int, j: int) -> None:
            rank = self.ranks.get(self.by_id[ids[i]] + self.by_id[ids[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, ids[i], ids[j]))

        while heap:
            rank, i, j, left, right = heapq.heappop(heap)
            if ids[i] != left or after[i] != j or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                look(i, after[i])
            if before[i] >= 0:
                look(before[i], i)
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> None:
        """Adds the ids of pieces to self.pieces."""
        buckets: dict[int, list[bytes]] = {}
        for p in pieces:
            whole = self.ranks.get(p)
            if whole is not None:
                self.pieces[p] = np.array([whole], np.int32)
            elif len(p) > LONGEST:
                self.pieces[p] = self.merge_long(p)
            else:
                width = next((b for b in BUCKETS if len(p) <= b), 1 << (len(p) - 1).bit_length())
                buckets.setdefault(width, []).append(p)
        for width, group in buckets.items():
            rows = max(1, CELLS // width)
            for k in range(0, len(group), rows):
                part = group[k : k + rows]
                self.pieces.update(zip(part, self.merge_matrix(part), strict=True))

    def _encode_units(self, units: list[bytes], _: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        split = [[p.encode() for p in self.pattern.findall(u.decode())] for u in units]
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        self.encode_pieces(list({p for ps in split for p in ps if p not in self.pieces}))
        get = self.pieces.__getitem__
        found = [get(p) for ps in split for p in ps]
        sizes = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))]
        lens = np.diff(sizes[np.r_[0, np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]])
        return np.concatenate(found) if found else np.zeros(0, np.int32), lens

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each)."""
        t = Texts(data, offsets)
        suspect = t.counts(((data >= 0x1C) & (data <= 0x1F)) | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))) > 0
        odd = [d for d in np.flatnonzero(suspect) if OTHER_SPACE.search(data[offsets[d] : offsets[d + 1]].tobytes().decode())]
        start, end, doc = words_with_space(t)
        if not odd:
            return self.cache.ids(t, start, end, doc)
        plain = ~np.isin(doc, odd)
        flat, counts = self.cache.ids(t, start[plain], end[plain], doc[plain])
        ends = np.cumsum(counts)
        parts, done = [], 0
        for d in odd:
            parts.append(flat[done : ends[d]])
            ids = self._encode_units([data[offsets[d] : offsets[d + 1]].tobytes()])[0]
            parts.append(ids)
            done, counts[d] = ends[d], len(ids)
        return np.concatenate([*parts, flat[done:]]), counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, token after token."""
        lens = self.token_lens[ids]
        ends = np.cumsum(lens)
        return self.token_bytes[np.repeat(self.token_starts[ids] - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)]


def _binary(vocabulary: Vocabulary, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The decoded bytes of each text, whose ids stand one after the other in flat."""
    sizes = np.r_[0, np.cumsum(vocabulary.token_lens[flat])]
    ends = sizes[np.r_[0, np.cumsum(counts)]]
    decoded = b"".join(vocabulary.decode(flat[k : k + DECODED_AT_ONCE]).tobytes() for k in range(0, len(flat), DECODED_AT_ONCE))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(decoded)])


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """docs' doc_id and ids (array<int>) of the whole text, for every row. A null text is empty and has no ids. Other columns are ignored.

    path: a file of ranks (base64 bytes and rank in each line) that every executor has. Ids are those of tiktoken's
    encode_ordinary: a piece that is a token is that token, any other is merged by rank. Units are told apart by 64-bit hashes.
    decoded: adds the column `decoded`, the bytes that the ids stand for, in the same pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(path, pattern)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                flat, counts = vocabulary.encode_slice(data, offsets)
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(flat))
                columns = {"doc_id": batch.column("doc_id")[lo:hi], "ids": ids}
                if decoded:
                    columns["decoded"] = _binary(vocabulary, flat, counts)
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(freed(run), "doc_id long, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded (doc_id, ids) with the column `decoded`: the bytes that the ids stand for. Null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                ids = part.column("ids")
                flat = ids.values.to_numpy(zero_copy_only=False)[ids.offsets[0].as_py() : ids.offsets[-1].as_py()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "ids": ids, "decoded": _binary(vocabulary, flat, np.diff(ids.offsets.to_numpy()))})

    filled = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return filled.mapInArrow(freed(run), "doc_id long, ids array<int>, decoded binary")


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by spaces) and decoded_sha256 (of the decoded bytes) for every row of docs."""
    out = encode(docs, path, pattern, decoded=True)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(spread(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
