"""Hard negatives by rotated one-bit codes whose alignment with their vectors is stored.

A vector of whole numbers is rotated (signs drawn once, then a Walsh-Hadamard transform) and coded by signs, one bit a coordinate;
stored beside the code are its inner product with the vector, the alignment, and the length of what the code leaves over. What is
left over is coded again, LEVELS times in all. An anchor's rotated coordinates become PLANES bit planes, so that a code's product
with it is a sum of popcounts. The estimate from all levels differs from the true product by at most
|left over| * |anchor| + |coded part| * |anchor - planes| (Cauchy-Schwarz), without any chance of error. Rows whose interval can't
reach a place in the result are dropped, first by FIRST levels, then by all; what is left is scored in whole numbers.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.textbytes import freed
from foliospark.session import table, written

LEVELS, FIRST, PLANES = 8, 4, 8
SHARD_ROWS, MOST_SHARD_ROWS, SHARDS = 4096, 131_072, 64  # rows of a shard grow from the first to the second once there are so many shards
ANCHOR_ROWS = 4096  # of a block that meets a shard, about
LONG = (-(2**63), 2**63 - 1)


@lru_cache(maxsize=4)
def _signs(width: int) -> np.ndarray:
    return np.where(np.random.Generator(np.random.PCG64(17)).random(width) < 0.5, -1.0, 1.0)


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows rotated in a space of a power of two dimensions, 64 at least; lengths and inner products stay."""
    width = max(64, 1 << (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    y *= _signs(width)
    half = 1
    while half < width:
        pairs = y.reshape(len(x), -1, 2, half)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), width)
        half *= 2
    return y / math.sqrt(width)


def coded(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes [row, level, word], alignments [row, level], lengths of what is left after each level [row, level]) of rotated rows."""
    n, width = y.shape
    codes = np.zeros((n, LEVELS, width // 64), np.uint64)
    align, left = np.zeros((n, LEVELS)), np.zeros((n, LEVELS))
    rest, root = y.copy(), math.sqrt(width)
    for k in range(LEVELS):
        up = rest > 0
        codes[:, k] = np.packbits(up, axis=1, bitorder="little").view(np.uint64)
        align[:, k] = np.abs(rest).sum(axis=1) / root
        rest -= np.where(up, 1.0, -1.0) * (align[:, k, None] / root)
        left[:, k] = np.sqrt((rest**2).sum(axis=1))
    return codes, align, left


class Anchor:
    """One anchor's bit planes and how far they are from its rotated coordinates."""

    def __init__(self, y: np.ndarray):
        self.norm = float(np.sqrt((y**2).sum()))
        self.least = float(y.min())
        self.step = float(y.max() - y.min()) / ((1 << PLANES) - 1) or 1.0
        u = np.rint((y - self.least) / self.step).astype(np.int64)
        near = self.least + self.step * u
        self.total = float(near.sum())
        self.off = float(np.sqrt(((y - near) ** 2).sum()))
        self.planes = np.packbits((u[None, :] >> np.arange(PLANES)[:, None] & 1).astype(bool), axis=1, bitorder="little").view(np.uint64)


class Shard:
    """The rows of one shard, sorted by label and vec_id."""

    def __init__(self, rows: pa.Table, dim: int):
        label, ids = rows.column("label").to_numpy(), rows.column("vec_id").to_numpy()
        order = np.lexsort((ids, label))
        self.label, self.ids = label[order], ids[order]
        self.whole = _matrix(rows.column("whole"), np.int64, dim)[order]
        width = max(64, 1 << (dim - 1).bit_length())
        self.root = math.sqrt(width)
        codes = _matrix(rows.column("codes"), np.uint64, LEVELS * (width // 64))[order].reshape(len(order), LEVELS, -1)
        self.codes = np.ascontiguousarray(codes.transpose(1, 2, 0))  # [level, word, row]
        self.ones = np.bitwise_count(self.codes).sum(axis=1, dtype=np.int64)
        self.align = np.ascontiguousarray(_matrix(rows.column("align"), np.float64, LEVELS)[order].T)
        self.left = np.ascontiguousarray(_matrix(rows.column("rest"), np.float64, LEVELS)[order].T)
        self.norm = np.sqrt((self.whole.astype(float) ** 2).sum(axis=1))
        self.most = float(np.abs(self.whole.astype(float)).max(initial=0))

    def products(self, anchor: Anchor, levels: range, at: np.ndarray | slice) -> np.ndarray:
        """The codes' share in the inner products of rows `at` with an anchor, over some levels: sums of popcounts."""
        out = 0.0
        for k in levels:
            counts = np.zeros(len(self.ids[at]), np.int32)
            for w in range(self.codes.shape[1]):
                code = self.codes[k, w][at]
                for j in range(PLANES):
                    counts += np.multiply(np.bitwise_count(code & anchor.planes[j, w]), 1 << j, dtype=np.int32)
            on = anchor.least * self.ones[k][at] + anchor.step * counts
            out = out + self.align[k][at] * ((2 * on - anchor.total) / self.root)
        return out

    def interval(self, anchor: Anchor, estimate: np.ndarray, level: int, at: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) that the true products can be."""
        norm, left = self.norm[at], self.left[level][at]
        off = left * anchor.norm + (norm + left) * anchor.off + 1e-9 * norm * anchor.norm + 1e-6
        return estimate - off, estimate + off

    def scores(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whole-number inner products; those that no long holds become the nearest long."""
        if self.most * float(np.abs(anchor.astype(float)).max(initial=0)) * max(1, len(anchor)) < 2**62:
            return self.whole[at] @ anchor
        exact = self.whole[at].astype(object) @ anchor.astype(object)
        return np.array([min(max(int(x), LONG[0]), LONG[1]) for x in exact], np.int64)

    def first(self, found: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[found], ~scores))[:k]
        return self.ids[found[order]], scores[order]

    def positives(self, own: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k first rows of the anchor's label, itself left out."""
        a, b = np.searchsorted(self.label, label, "left"), np.searchsorted(self.label, label, "right")
        at = np.arange(a, b)[self.ids[a:b] != own]
        if len(at) > k:
            coded_anchor = Anchor(rotated(anchor[None, :])[0])
            estimate = 0.0
            for levels in (range(FIRST), range(FIRST, LEVELS)):
                estimate = estimate + self.products(coded_anchor, levels, at)
                low, high = self.interval(coded_anchor, estimate, levels[-1], at)
                keep = high >= np.partition(low, len(low) - k)[len(low) - k]
                at, estimate = at[keep], estimate[keep]
        return self.first(at, self.scores(anchor, at), k)

    def negatives(self, label: int, anchor: np.ndarray, wanted: list[int], k: int, share: tuple[int, int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(positive's score, ids, scores) of the k first rows of other labels in each positive's band of scores."""
        a, b = np.searchsorted(self.label, label, "left"), np.searchsorted(self.label, label, "right")
        at = np.r_[np.arange(a), np.arange(b, len(self.ids))]
        wanted = sorted({p for p in wanted if share[0] * p <= share[1] * p})  # below 0 no score is in the band
        coded_anchor = Anchor(rotated(anchor[None, :])[0])
        estimate = 0.0
        for levels in (range(FIRST), range(FIRST, LEVELS)):
            if not len(at) or not wanted:
                break
            estimate = estimate + self.products(coded_anchor, levels, slice(None) if levels[0] == 0 and a == b else at)
            low, high = self.interval(coded_anchor, estimate, levels[-1], at)
            keep = np.zeros(len(at), bool)
            for p in wanted:
                least, most = share[0] * p / 100, share[1] * p / 100
                may = (high >= least) & (low <= most)
                sure = low[(low >= least) & (high <= most)]
                if len(sure) >= k:
                    may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
                keep |= may
            at, estimate = at[keep], estimate[keep]
        scores = self.scores(anchor, at)
        out = []
        for p in wanted:
            least, most = -(-share[0] * p // 100), share[1] * p // 100
            inside = (scores >= least) & (scores <= most)
            out.append((p, *self.first(at[inside], scores[inside], k)))
        return out


def _matrix(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    parts = [np.frombuffer(c.buffers()[2], np.uint8)[np.frombuffer(c.buffers()[1], np.int32)[c.offset] : np.frombuffer(c.buffers()[1], np.int32)[c.offset + len(c)]] for c in column.chunks if len(c)]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint8)).view(kind).reshape(-1, width)


def coded_rows(rows: DataFrame) -> DataFrame:
    """vec_id, label, dim, whole (the numbers as 64-bit), codes, align and rest for vec_id, label, v (array<long>)."""

    def run(batches):
        for batch in batches:
            v = batch.column("v")
            dims = v.value_lengths().to_numpy(zero_copy_only=False)
            flat, starts = v.flatten().to_numpy(zero_copy_only=False), np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = flat[starts[at][:, None] + np.arange(dim)]
                codes, align, left = coded(rotated(x.astype(float)))
                binary = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
                take = pa.array(at)
                columns = [batch.column("vec_id").take(take), batch.column("label").take(take), pa.array(np.full(len(at), dim, np.int32)), *map(binary, (x, codes, align, left))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "dim", "whole", "codes", "align", "rest"])

    return rows.select("vec_id", "label", "v").mapInArrow(freed(run), "vec_id long, label long, dim int, whole binary, codes binary, align binary, rest binary")


def hard_negatives(rows: DataFrame, anchors: str, positives: int = 5, negatives: int = 3, share: tuple[int, int] = (50, 95)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for rows (vec_id, label, v as array<long>).

    anchors: a condition on vec_id. An anchor's positives are its first rows of the same label by inner product (ties to the smaller
    vec_id), and each positive's negatives the first of those rows of other labels whose product is share[0] to share[1] per cent of the positive's.
    Rows with a null vec_id, label or vector, an empty vector or a null in it take no part; vectors meet those of equal length only. Of rows that repeat a
    vec_id the one of the smallest label, then vector, counts. Scores beyond a long count as the nearest long. An anchor without positives, and a
    positive without negatives, has no rows; an empty table gives none. Other columns are ignored.

    Rows are dealt into shards and anchors into blocks by hashes; every block meets every shard, twice: for positives, then for negatives.
    """
    usable = rows.filter("vec_id is not null and label is not null and size(v) > 0 and forall(v, x -> x is not null)").select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "v")
    single = usable.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    stored = written(coded_rows(single), "hard-negative-codes")
    n, n_anchors = stored.agg(F.count("*"), F.count_if(F.expr(anchors))).first()
    shard_rows = min(MOST_SHARD_ROWS, max(SHARD_ROWS, n // SHARDS))
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(n_anchors / ANCHOR_ROWS))
    dealt = lambda parts, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = stored.withColumn("shard", dealt(shards, 1)).withColumn("block", each(blocks))
    asked = stored.filter(anchors).select("vec_id", "label", "dim", "whole", dealt(blocks, 2).alias("block"))
    keys = ("dim", "shard", "block")

    def meet(step, names, kinds):
        def run(rows_: pa.Table, asked_: pa.Table) -> pa.Table:
            out: tuple[list, ...] = tuple([] for _ in names)
            if rows_.num_rows and asked_.num_rows:
                dim = rows_.column("dim")[0].as_py()
                shard, vectors = Shard(rows_, dim), _matrix(asked_.column("whole"), np.int64, dim)
                for i, (own, label) in enumerate(zip(asked_.column("vec_id").to_pylist(), asked_.column("label").to_pylist(), strict=True)):
                    for values in step(shard, own, label, vectors[i], asked_, i):
                        for column, value in zip(out, values, strict=True):
                            column.extend(value)
            return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

        return run

    def near(shard, own, label, vector, _, __):
        ids, scores = shard.positives(own, label, vector, positives)
        yield [own] * len(ids), ids.tolist(), scores.tolist()

    def far(shard, own, label, vector, asked_, i):
        wanted = asked_.column("wanted")[i].as_py()
        for p, ids, scores in shard.negatives(label, vector, wanted, negatives, share):
            yield [own] * len(ids), [p] * len(ids), ids.tolist(), scores.tolist()

    long = pa.int64()
    everywhere = lambda df: df.withColumn("shard", each(shards)).groupBy(*keys)
    found = left.groupBy(*keys).cogroup(everywhere(asked)).applyInArrow(meet(near, ["anchor_id", "positive_id", "positive_score"], [long] * 3), "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = written(found.withColumn("__r", F.row_number().over(first)).filter(F.col("__r") <= positives).drop("__r"), "hard-negative-positives")
    with_scores = asked.join(chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("wanted")), "vec_id")
    with_scores = with_scores.select(*(F.col(c).alias(c) for c in with_scores.columns))  # columns of its own
    found = left.groupBy(*keys).cogroup(everywhere(with_scores)).applyInArrow(meet(far, ["anchor_id", "positive_score", "negative_id", "negative_score"], [long] * 4), "anchor_id long, positive_score long, negative_id long, negative_score long")
    last = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hard = found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= negatives)
    return chosen.join(hard, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    usable = "label is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    rows = table(spark, sf_dir, "embeddings").filter(usable)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), whole.alias("v")), "vec_id % 50 = 0")


ORACLE = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 3"""
