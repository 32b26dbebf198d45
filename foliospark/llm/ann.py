"""Approximate nearest neighbours by a hash-prefix forest.

Rows are dealt evenly into shards. A shard indexes each of its distinct vectors in many trees: a tree is the sorted array of
long hash strings, the signs of random projections. A query descends each tree to its longest matching prefix; then all trees ascend
together, one prefix bit at a time, until the subtrees hold enough candidates, whose exact inner products are taken. Every query
meets every shard, and the shards' lists are merged.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.session import table

TREES, BITS = 64, 32
SHARD_ROWS = 4096  # about; the number of shards grows with the table
QUERY_ROWS = 8192  # of a block that meets a shard, about
#: Candidates wanted, as a share of a shard's distinct vectors counted once a tree, and at least so many. Vectors without any
#: structure (as the synthetic ones) need about 0.4 of all rows for a recall of 0.9, and this gives about 0.95; clustered ones need far less.
SHARE, LEAST = 0.8, 2000


@lru_cache(maxsize=2)
def _directions(dim: int, trees: int, bits: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(11)).standard_normal((dim + 1, trees * bits)).astype(np.float32)


def _strings(x: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Hash strings, one row a tree: the signs of the projections as whole numbers, the first bit highest."""
    signs = (x.astype(np.float32) @ _directions(x.shape[1] - 1, trees, bits) > 0).reshape(len(x), trees, bits)
    return (signs @ (np.uint64(1) << np.arange(bits, dtype=np.uint64)[::-1])).T.astype(np.uint64)


class Forest:
    """The trees of one shard over its distinct vectors; queries are compared by inner product in double precision."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, trees: int = TREES, bits: int = BITS):
        order = np.lexsort((ids,))
        ids, vectors = ids[order], vectors[order]
        self.vectors, inverse = np.unique(vectors, axis=0, return_inverse=True)
        by_class = np.argsort(inverse, kind="stable")
        self.members = np.split(ids[by_class], np.cumsum(np.bincount(inverse))[:-1])
        # inner product is nearness of angle once a further coordinate brings all vectors to one norm
        rest = np.sqrt(np.maximum(norm**2 - (self.vectors**2).sum(axis=1), 0))
        strings = _strings(np.c_[self.vectors, rest], trees, bits)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)
        self.trees, self.bits = trees, bits

    def ranges(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) [tree, query]: in each tree, the places under the prefix where the trees' ascent stops."""
        strings = _strings(np.c_[queries, np.zeros(len(queries))], self.trees, self.bits)
        lo = np.zeros(strings.shape, np.int64)
        hi = np.zeros(strings.shape, np.int64)
        open_ = np.ones(len(queries), bool)
        for level in range(min(self.bits, math.ceil(math.log2(len(self.vectors) + 1)) + 4), -1, -1):
            if not open_.any():
                break
            at = np.flatnonzero(open_)
            before_lo, before_hi = lo[:, at], hi[:, at]
            new_lo, new_hi = np.empty_like(before_lo), np.empty_like(before_hi)
            shift = np.uint64(self.bits - level)
            for t in range(self.trees):
                low = (strings[t, at] >> shift) << shift
                new_lo[t] = np.searchsorted(self.sorted[t], low, "left")
                new_hi[t] = np.searchsorted(self.sorted[t], low + (np.uint64(1) << shift) - np.uint64(1), "right")
            # trees ascend one after the other inside a level, and stop where there are candidates enough
            extra = (new_hi - new_lo) - (before_hi - before_lo)
            had = (before_hi - before_lo).sum(axis=0)
            upto = had + np.cumsum(extra, axis=0)
            move = np.vstack([np.ones(len(at), bool), upto[:-1] < wanted])
            lo[:, at], hi[:, at] = np.where(move, new_lo, before_lo), np.where(move, new_hi, before_hi)
            open_[at] = upto[-1] < wanted
        return lo, hi

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, wanted: int) -> tuple[list, list, list]:
        lo, hi = self.ranges(queries, wanted)
        out: tuple[list, list, list] = ([], [], [])
        for q, (own, vector) in enumerate(zip(query_ids.tolist(), queries, strict=True)):
            mark = np.zeros(len(self.vectors), bool)
            mark[np.concatenate([self.order[t, a:b] for t, (a, b) in enumerate(zip(lo[:, q].tolist(), hi[:, q].tolist(), strict=True))])] = True
            found = np.flatnonzero(mark)
            rough = self.vectors[found] @ vector
            if len(found) > k + 1:
                edge = np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1]
                found = found[rough >= edge - 1e-9 * max(1.0, abs(edge))]
            exact = (self.vectors[found] * vector).sum(axis=1)
            pairs = [(-s, i) for s, c in zip(exact.tolist(), found.tolist(), strict=True) for i in self.members[c][: k + 1].tolist() if i != own]
            for s, i in sorted(pairs)[:k]:
                out[0].append(own)
                out[1].append(i)
                out[2].append(-s)
        return out


def nearest(points: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k rows of points with the largest inner product found, ties to the smaller vec_id.

    points and queries: vec_id, embedding (array of float or double); other columns are ignored. A row with the query's vec_id is
    never its neighbour. Vectors that are null, empty, zero or hold nulls or non-finite numbers take no part, nor do rows without a
    vec_id; vectors meet those of equal length only. Repeated queries count once, repeated rows stay candidates each. A query
    with fewer than k candidates has them all; without any it has no rows.
    """
    whole = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"
    usable = lambda df: df.select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: x.cast("double")).alias("v")).withColumnRenamed("v", "embedding").filter(whole)
    points, queries = usable(points), usable(queries).dropDuplicates(["vec_id"])
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    n, most = points.agg(F.count("*"), F.max(norm)).first()
    n_queries = queries.count()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(n_queries / QUERY_ROWS))
    most = float(most or 1.0)
    dealt = lambda parts, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = points.select("vec_id", "embedding", F.size("embedding").alias("dim"), dealt(shards, 1).alias("shard"), each(blocks).alias("block"))
    right = queries.select("vec_id", "embedding", F.size("embedding").alias("dim"), each(shards).alias("shard"), dealt(blocks, 2).alias("block"))

    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        out: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and asked.num_rows:
            matrix = lambda t: t.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
            forest = Forest(rows.column("vec_id").to_numpy(), matrix(rows), most)
            wanted = max(LEAST, math.ceil(SHARE * len(forest.vectors)))
            out = forest.search(asked.column("vec_id").to_numpy(), matrix(asked), k, wanted)
        return pa.table([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=names)

    keys = ("dim", "shard", "block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann_prefix_forest(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.filter("vec_id % 20 = 0"))
