"""Packing of token pieces into sequences by the dominance reduction of Martello and Toth, then best fit.

Only the number of pieces of each length matters for a plan, and there are no more lengths than a sequence has places: the plan is
made on that histogram, whatever the number of documents. The reduction fixes sets of at most three lengths that no other filling
of their sequence could beat (an exact pair, the only piece or pair that fits, a dominating triple), as often as their counts allow;
what is left goes to the fullest sequence that has room, longest first, equal sequences in one step. Pieces are then numbered within their length,
task by task, and the plan says for each range of numbers which sequences and offsets it gets.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.bpe import OTHER_SPACE
from foliospark.llm.textbytes import IS_SEPARATOR, Texts, freed, slices
from foliospark.llm.tokenstore import IS_MARK, _is_letter
from foliospark.llm.units import UnitCache, words_with_space
from foliospark.session import spread, table, written


class ByteLevelEncoder:
    """Ids of whole texts by a tokenizers file.

    Where the file is plain byte-level BPE, a text's units (white space and a word; marks after letters) are encoded one by one, each
    distinct one once: new ones many at a time in one text, told apart by the bytes that their tokens stand for. Texts with white space beyond
    ASCII or with a special token, and all texts under other files, are encoded whole.
    """

    AT_ONCE = 4000

    def __init__(self, path: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        before = said.get("pre_tokenizer") or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.by_units = all(before.get(k) == v for k, v in plain.items()) and not (said.get("normalizer") or said.get("post_processor")) and (said.get("model") or {}).get("type") == "BPE"
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each token: its characters, in the byte-level alphabet
        self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.special = [t["content"].encode() for t in said.get("added_tokens") or []]
        self.cache = UnitCache(self._encode, most)

    def _alone(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, units: list[bytes], _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(units)
        joins = [i for i, u in enumerate(units) if IS_SEPARATOR[u[0]] and not IS_SEPARATOR[u[-1]]]
        for k in range(0, len(joins), self.AT_ONCE):
            some = joins[k : k + self.AT_ONCE]
            ids = self._alone(["".join(units[i].decode() for i in some)])[0]
            ends = np.cumsum([len(units[i]) for i in some])
            at = np.cumsum(self.sizes[ids])
            stop = np.searchsorted(at, ends)
            if len(at) and (at[np.minimum(stop, len(at) - 1)] == ends).all():
                for i, a, b in zip(some, np.r_[0, stop[:-1] + 1].tolist(), (stop + 1).tolist(), strict=True):
                    out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for k in range(0, len(rest), self.AT_ONCE):
            some = rest[k : k + self.AT_ONCE]
            for i, ids in zip(some, self._alone([units[i].decode() for i in some]), strict=True):
                out[i] = ids
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _whole(self, t: Texts, data: np.ndarray) -> list[int]:
        """Texts that units can't stand for."""
        if not self.by_units:
            return list(range(t.n))
        raw, found = data.tobytes(), set()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                found.add(int(np.searchsorted(t.offsets, at, "right")) - 1)
                at = raw.find(token, at + 1)
        suspect = t.counts(((data >= 0x1C) & (data <= 0x1F)) | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))) > 0
        found.update(d for d in np.flatnonzero(suspect).tolist() if OTHER_SPACE.search(raw[t.offsets[d] : t.offsets[d + 1]].decode()))
        return sorted(found)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, how many each has)."""
        t = Texts(data, offsets)
        odd = self._whole(t, data)
        start, end, doc = words_with_space(t)
        if len(odd):
            keep = ~np.isin(doc, odd)
            start, end, doc = start[keep], end[keep], doc[keep]
        if len(start):
            start, end, doc = self._apart(data, t, start, end, doc)
        flat, counts = self.cache.ids(t, start, end, doc)
        if not len(odd):
            return flat, counts
        raw, ends, parts, done = data.tobytes(), np.cumsum(counts), [], 0
        for d in odd:
            parts.append(flat[done : ends[d]])
            parts.append(self._alone([raw[offsets[d] : offsets[d + 1]].decode()])[0])
            done, counts[d] = ends[d], len(parts[-1])
        return np.concatenate([*parts, flat[done:]]), counts

    def _apart(self, data: np.ndarray, t: Texts, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units with the marks after a word of letters as units of their own: no match of the splitting pattern goes over that place."""
        at = np.arange(len(data))
        core = np.maximum.accumulate(np.where(IS_MARK[data], -1, at))[end - 1] + 1
        word = np.searchsorted(t.start, start)  # the word that begins in the unit
        head = t.start[np.minimum(word, len(t.start) - 1)] if len(t.start) else start
        odd = np.r_[0, np.cumsum(~_is_letter(data))]
        cut = (core > head) & (core < end) & (head >= start) & (head < end)
        cut[cut] = odd[core[cut]] == odd[head[cut]]
        tails = np.flatnonzero(cut)
        first_end = end.copy()
        first_end[tails] = core[tails]
        return np.insert(start, tails + 1, core[tails]), np.insert(first_end, tails + 1, end[tails]), np.insert(doc, tails + 1, doc[tails])


@lru_cache(maxsize=1)
def _encoder(path: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(path)


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int, id_bytes: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian, id_bytes each), ids_crc32 (of the ids in 4 bytes each), part and place of every piece of docs.

    A document's ids end with end_id; more than `capacity` are cut into pieces of that length, of which the first may be shorter.
    part and place number the pieces of one length in one task, from 0.
    """
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, used = _encoder(path), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                flat, counts = encoder(data, offsets)
                flat = np.insert(flat, np.cumsum(counts), end_id)
                counts = counts + 1
                pieces = -(-counts // capacity)
                doc = np.repeat(np.arange(len(counts)), pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (counts - (pieces - 1) * capacity)[doc]
                start = np.where(number == 0, 0, first + (number - 1) * capacity)
                length = np.where(number == 0, first, capacity)
                order = np.argsort(length, kind="stable")
                runs = length[order]
                place = np.empty(len(length), np.int64)
                place[order] = np.arange(len(runs)) - np.searchsorted(runs, runs) + used[runs]
                used += np.bincount(length, minlength=capacity + 1)
                ends = np.cumsum(length)
                wide = memoryview(flat.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist(), strict=True)]
                ids = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer((np.r_[0, ends] * id_bytes).astype(np.int32)), pa.py_buffer(flat.astype(kind).tobytes())])
                columns = [batch.column("doc_id")[lo:hi].take(pa.array(doc)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), ids, pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part, np.int32)), pa.array(place)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "part", "place"])

    return docs.select("doc_id", "text").mapInArrow(freed(run), "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, part int, place long")


class Reduction:
    """The dominance reduction on how often each length occurs. A decision looks at no more than three pieces of a length, so it stands for all but the last few."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {w: n for w, n in counts.items() if n}
        self.lengths = sorted(self.left)
        self.fixed: list[tuple[int, tuple[int, ...]]] = []  # (how many sequences, their lengths)

    def _others(self, j: int, most: int) -> list[int]:
        """The `most` shortest pieces but one of length j."""
        out: list[int] = []
        for w in self.lengths:
            out += [w] * min(most - len(out), self.left[w] - (w == j))
            if len(out) == most:
                break
        return out

    def _longest(self, room: int, *gone: int) -> int | None:
        """The longest piece of at most `room`, when those of `gone` are taken."""
        i = bisect_right(self.lengths, room) - 1
        while i >= 0 and self.left[self.lengths[i]] <= gone.count(self.lengths[i]):
            i -= 1
        return self.lengths[i] if i >= 0 else None

    def dominating(self, j: int) -> tuple[int, ...] | None:
        """A set with j that is at least as good as any other filling of j's sequence, if one of three pieces or fewer is known to be."""
        room = self.capacity - j
        small = self._others(j, 3)
        if not small or small[0] > room:
            return (j,)
        best = self._longest(room, j)
        if best == room or len(small) == 1 or small[0] + small[1] > room:
            return (j, best)
        if len(small) == 3 and sum(small) <= room:
            return None
        pair, top = None, -1  # the heaviest two that fit
        for a in reversed(self.lengths[: bisect_right(self.lengths, room)]):
            if 2 * a <= top or self.left[a] <= (a == j):
                continue
            b = self._longest(min(a, room - a), j, a)
            if b is not None and a + b > top:
                pair, top = (a, b), a + b
        if pair is None or best >= top:
            return (j, best)
        a, b = pair
        if a == best:
            heavier: list[int] = []
            for w in self.lengths[bisect_right(self.lengths, b) :]:
                heavier += [w] * min(2 - len(heavier), self.left[w] - (w == j) - (w == a))
                if len(heavier) == 2:
                    break
            if len(heavier) < 2 or sum(heavier) > room:
                return (j, a, b)
        return None

    def take(self, pieces: tuple[int, ...]) -> None:
        """Fixes sequences of these pieces: as many as leave three of each length or more, else one."""
        uses = {w: pieces.count(w) for w in pieces}
        n = max(1, min((self.left[w] - 3) // k for w, k in uses.items()))
        self.fixed.append((n, pieces))
        for w, k in uses.items():
            self.left[w] -= n * k
            if not self.left[w]:
                del self.left[w]
                self.lengths.remove(w)

    def run(self) -> None:
        changed = True
        while changed:
            changed = False
            for j in sorted(self.left, reverse=True):
                while j in self.left and (found := self.dominating(j)):
                    self.take(found)
                    changed = True


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how many sequences, [(length, how many in each)]): pieces by falling length into the fullest sequence with room, all equal steps at once."""
    rooms: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {capacity: []}
    order = [capacity]

    def put(room: int, n: int, inside: list[tuple[int, int]]) -> None:
        if room not in rooms:
            rooms[room] = []
            insort(order, room)
        rooms[room].append((n, inside))

    for w in sorted(counts, reverse=True):
        left = counts[w]
        while left:
            at = bisect_left(order, w)
            while order[at] < capacity and not rooms[order[at]]:
                del rooms[order.pop(at)]
            room = order[at]
            each = room // w
            n, inside = rooms[room].pop() if rooms[room] else (left, [])  # new sequences, as many as need be
            take = min(n, left // each)
            if take:
                put(room - each * w, take, [*inside, (w, each)])
                left, n = left - take * each, n - take
            else:
                put(room - left * w, 1, [*inside, (w, left)])
                left, n = 0, n - 1
            if n and inside:
                put(room, n, inside)
    return [g for gs in rooms.values() for g in gs]


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, each, offset): pieces number first to last - 1 of a length stand in sequences from `sequence` on, `each` in one, from offset on."""
    reduction = Reduction(counts, capacity)
    reduction.run()
    groups = [(n, [(w, pieces.count(w)) for w in sorted(set(pieces), reverse=True)]) for n, pieces in reduction.fixed]
    groups += best_fit(reduction.left, capacity)
    used, sequence, out = dict.fromkeys(counts, 0), 0, []
    for n, inside in groups:
        offset = 0
        for w, each in inside:
            out.append((w, used[w], used[w] + n * each, sequence, each, offset))
            used[w] += n * each
            offset += w * each
        sequence += n
    return out


def packed(docs: DataFrame, path: str, end_id: int, capacity: int = 1024, id_bytes: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id and offset of every piece of docs (doc_id, text).

    A null text is empty and has the end id alone; rows with a null doc_id and repeated rows are packed like any other. An empty
    table gives no rows. Other columns are ignored. The driver sees one number for each length, of `capacity` at most; the plan that
    is broadcast has a few rows for each of them. Pieces are encoded once, into a table in the shared folder, without a shuffle.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, path, end_id, capacity, id_bytes), "packing-pieces", compression="zstd")
    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts")
    plan = packing_plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    offsets = counts.select(F.col("part"), F.col("length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    ranges = spark.createDataFrame(plan, "__length long, __first long, __last long, __sequence long, __each long, __offset long")
    d = pieces.join(offsets, ["part", "length"]).withColumn("__number", F.col("place") + F.col("__before"))
    d = d.join(F.broadcast(ranges), (F.col("length") == F.col("__length")) & (F.col("__number") >= F.col("__first")) & (F.col("__number") < F.col("__last")))
    at = F.col("__number") - F.col("__first")
    sequence, offset = F.col("__sequence") + F.floor(at / F.col("__each")).cast("long"), F.col("__offset") + at % F.col("__each") * F.col("length")
    return d.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", sequence.alias("sequence_id"), offset.alias("offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, doc_ids and ids of each packed sequence, its pieces one after the other; a sequence holds `capacity` pieces at most."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    d = pieces.groupBy("sequence_id").agg(ordered.alias("p"))
    ids = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), ""))
    return d.select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), ids.alias("ids"))


def op11_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packed(spread(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
