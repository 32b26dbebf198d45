"""Packing: ids against the tokenizers library, plans against exhaustive search and lower bounds, gapless sequences."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from foliospark.llm import packing
from foliospark.session import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(sizes, capacity):
    """The least number of sequences, by search over all partial fillings."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def filled(plan, counts, capacity):
    """The number of sequences of a plan, after checking that every piece has one place and none overlaps."""
    taken, inside = {w: [] for w in counts}, {}
    for w, first, last, sequence, each, offset in plan:
        taken[w].append((first, last))
        for n in range(first, last):
            inside.setdefault(sequence + (n - first) // each, []).append((offset + (n - first) % each * w, w))
    for w, ranges in taken.items():
        assert [n for a, b in sorted(ranges) for n in range(a, b)] == list(range(counts[w]))
    for places in inside.values():
        at = 0
        for offset, w in sorted(places):
            assert offset == at
            at += w
        assert at <= capacity
    assert sorted(inside) == list(range(len(inside)))
    return len(inside)


@pytest.mark.parametrize("seed", range(60))
def test_reduction_loses_no_sequence(seed):
    """What the reduction fixes belongs to some best packing: the fixed sequences and the best packing of the rest are as few as the best of all."""
    rng = random.Random(seed)
    capacity = rng.choice((10, 20, 30))
    sizes = [rng.randint(rng.choice((1, 3, capacity // 4)), capacity) for _ in range(rng.randint(1, 11))]
    counts = {w: sizes.count(w) for w in sizes}
    r = packing.Reduction(counts, capacity)
    r.run()
    rest = [w for w, n in r.left.items() for _ in range(n)]
    assert sum(n for n, _ in r.fixed) + fewest(rest, capacity) == fewest(sizes, capacity)
    assert sorted(rest + [w for n, ws in r.fixed for w in ws * n]) == sorted(sizes)
    assert filled(packing.packing_plan(counts, capacity), counts, capacity) <= fewest(sizes, capacity) + 1


def test_bulk_steps_equal_single_ones():
    rng = random.Random(4)
    for _ in range(30):
        counts = {w: rng.randint(0, 9) for w in range(1, 21)}
        got = filled(packing.packing_plan(counts, 20), counts, 20)
        r = packing.Reduction(counts, 20)
        r.run()
        rooms = []  # plain best fit, piece by piece
        for w in sorted((w for w, n in r.left.items() for _ in range(n)), reverse=True):
            fits = [k for k, room in enumerate(rooms) if room >= w]
            if fits:
                rooms[min(fits, key=lambda k: rooms[k])] -= w
            else:
                rooms.append(20 - w)
        assert got == sum(n for n, _ in r.fixed) + len(rooms)


def test_large_counts_need_few_steps():
    rng = random.Random(5)
    counts = {w: int(10 ** rng.uniform(0, 9)) for w in range(1, 1025)}
    plan = packing.packing_plan(counts, 1024)
    assert len(plan) < 20_000
    total = sum(w * n for w, n in counts.items())
    used = max(sequence + -(-(last - first) // each) for _, first, last, sequence, each, _ in plan)
    large = sum(n for w, n in counts.items() if w > 512)
    assert max(large, -(-total // 1024)) <= used <= 1.04 * max(large, -(-total // 1024))


def checked(spark, docs, capacity=1024):
    rows = packing.packed(docs, PATH, 2, capacity).collect()
    encoder = packing._encoder(PATH).tokenizer
    got, inside = {}, {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) and r.length == len(r.ids) // 2
        got.setdefault(r.doc_id, []).append((r.piece, r.start, np.frombuffer(r.ids, "<u2").tolist()))
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in inside.values():
        assert [o for o, _ in sorted(places)] == [0, *itertools.accumulate(n for _, n in sorted(places))][:-1]
        assert sum(n for _, n in places) <= capacity
    for doc_id, text in ((r.doc_id, r.text) for r in docs.collect()):
        want = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(got[doc_id])
        assert [x for *_, ids in pieces for x in ids] == want
        assert [p for p, *_ in pieces] == list(range(-(-len(want) // capacity))) and all(len(ids) == capacity for *_, ids in pieces[1:])
        assert [s for _, s, _ in pieces] == [0, *itertools.accumulate(len(ids) for *_, ids in pieces)][:-1]
    return rows, len(inside)


def test_odd_texts(spark):
    texts = [
        "", None, "   ", "a", "don't, can't. It's", "x" * 3000, "word " * 5000, "tab\there\n\n  two  spaces end ", "<|endoftext|>", "before <|endoftext|> after, it", "naïve café, déjà-vu!", "日本語 テキスト。", "a\u001cb c", " lead",
        "trail ", "123,456.78 %", "...", "a,", ",a", "'s 'S", "Ünï,c ode;", "\n", "\r\n x", "é,", "line\n\n\nline", "don'tx,", "“q”, he’s", "a​ b",
    ]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, length int, ids string")
    _, n = checked(spark, docs)
    checked(spark, docs, 16)
    assert n < len(texts)
    assert packing.packed(docs.limit(0), PATH, 2).count() == 0
    same = spark.createDataFrame([(1, "same row")] * 5 + [(None, "no id")] * 2, "doc_id long, text string")
    rows = packing.packed(same, PATH, 2, 6).collect()
    assert len(rows) == 7 and sum(r.doc_id is None for r in rows) == 2 and len({(r.sequence_id, r.offset) for r in rows}) == 7


def test_whole_table(spark, small):
    docs = table(spark, small, "documents")
    rows, n = checked(spark, docs)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1
    seen = packing.sequences(packing.packed(docs, PATH, 2)).collect()
    assert sum(r.n_tokens for r in seen) == sum(r.length for r in rows) and all(len(r.ids) == 2 * r.n_tokens for r in seen)
    query = packing.op11_best_fit_packing(spark, small)
    assert query.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and query.count() == len(rows)
