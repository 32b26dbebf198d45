"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree over blocks.

Every source's documents fall by a keyed hash into blocks of a permuted order. A source's target is met by whole passes over
all its blocks and one partial pass over the first blocks of that order (the last of them in part): these are its exact block quotas.
A binary tree splits all quotas among the output shards: each node draws how many blocks of every source and pass go left from the
multivariate hypergeometric distribution. A shard then draws as many blocks as it was given, disjointly, from a keyed permutation of each
pass's blocks; what no shard draws isn't taken. Inside a shard documents are shuffled by a keyed order. Every level of the tree is one
grouped step over sources, passes and nodes, whatever the rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.numbering import numbered
from foliospark.session import discard, spread, table, written

#: The weights that sources in code-point order take in turn.
WEIGHTS = (5, 2, 1)
WORD = "[^ \\t-\\r]+"
BLOCK_BITS = 10  # a source has 2**bits blocks: the most that leave 64 documents in a block, and at most 2**10, so blocks grow with large sources
MOST = 3  # times a source or document may be taken
SHARD_WORDS, LEAST_SHARDS = 1 << 26, 8  # shards are a power of two, of so many words at most where there are more than the least


def unit_key(seed: int, *columns: Column) -> Column:
    """A keyed hash of the columns as a whole number below 2**48, from md5 (the same in every engine)."""
    text = F.concat_ws("|", F.lit(str(seed)), *(c.cast("string") for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source_key, source, source_size, weight, target) of each source; targets share all words by weight, at most `most` times a source.

    Water filling in closed form: with sources ordered by most * size / weight, those whose limit is below the common level are
    full, and the rest share what remains by weight. One row a source: the windows run over that small table only.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    d = by_source.withColumn("rank", rank).withColumn("weight", weight)
    d = d.withColumn("limit", most * F.col("source_size")).withColumn("level", F.col("limit") / F.col("weight"))
    order = Window.orderBy("level", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0))).withColumn("spent", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    d = d.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    at = (F.col("total") - F.col("full")) / (F.col("weights") - F.col("spent"))  # the level if this and all later sources share
    d = d.withColumn("common", F.max(F.when(F.col("level") >= at, at)).over(everything))
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.coalesce("common", "level"))
    return d.select("rank", "source", "source_size", "n_docs", "weight", target.cast("double").alias("target"))


def split_node(counts: np.ndarray, lo: int, hi: int, seed: int) -> tuple[np.ndarray, int]:
    """(blocks of each quota that go left, first shard of the right half) at the node of the shards lo to hi - 1. The draw is without replacement and keyed by the node."""
    mid, total = (lo + hi) // 2, int(counts.sum())
    left = round(total * (mid - lo) / (hi - lo))
    rng = np.random.Generator(np.random.PCG64(int.from_bytes(hashlib.sha256(f"{seed}:{lo}:{hi}".encode()).digest()[:8], "big")))
    return (rng.multivariate_hypergeometric(counts, left, method="marginals") if total else counts * 0), mid


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, rank, pass, n) of exact quotas (rank, pass, n), by the splitting tree: both halves of a node get blocks in proportion to their shards."""

    def halves(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("rank", "ascending"), ("pass", "ascending")])
        lo, hi = rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py()
        counts = rows.column("n").to_numpy()
        left, mid = split_node(counts, lo, hi, seed)
        parts = [rows.select(["rank", "pass"]).append_column("n", pa.array(n, pa.int64())).append_column("lo", pa.array([a] * len(n), pa.int32())).append_column("hi", pa.array([b] * len(n), pa.int32())) for n, a, b in ((left, lo, mid), (counts - left, mid, hi))]
        return pa.concat_tables(parts)

    nodes = quotas.select("rank", "pass", F.col("n").cast("long").alias("n"), F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    for _ in range(math.ceil(math.log2(shards))):
        done = nodes.filter("hi - lo = 1")
        split = nodes.filter("hi - lo > 1").groupBy("lo", "hi").applyInArrow(halves, "rank int, pass int, n long, lo int, hi int").filter("n > 0")
        nodes = split if math.log2(shards) % 1 == 0 else split.unionByName(done)
    return nodes.select(F.col("lo").alias("shard"), "rank", "pass", "n")


def drawn_blocks(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """(rank, pass, block, shard): every block of units (rank, pass, block), each once, at the shard that draws it. Its size is sources * blocks * passes."""
    by_pass = units.groupBy("rank", "pass").agg(F.count("*").alias("n"))
    dealt = written(split_quotas(by_pass, shards, seed), "mix-quotas")
    upto = F.sum("n").over(Window.partitionBy("rank", "pass").orderBy("shard"))  # one row a shard
    places = dealt.withColumn("upto", upto).select("rank", "pass", "shard", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"))).alias("place"))
    order = Window.partitionBy("rank", "pass").orderBy(unit_key(seed + 1, F.col("rank"), F.col("pass"), F.col("block")), "block")  # 2**BLOCK_BITS rows at most
    return units.withColumn("place", F.row_number().over(order).cast("long")).join(places, ["rank", "pass", "place"]).select("rank", "pass", "block", "shard")


def fitted(edge: DataFrame) -> DataFrame:
    """edge (rank, key, doc_id, size, left) with `fits`: in keyed order, documents that fit what is left of their source's target after those before.

    Each round takes the longest beginning of those that still fit; rounds end when nothing more fits, so the target is missed by less
    than the smallest document that is left out.
    """
    block = Window.partitionBy("rank")
    inside = block.orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    now = written(edge.withColumn("fits", F.lit(False)), "mix-edge")
    while not now.filter("not fits and size <= left").isEmpty():
        may = ~F.col("fits") & (F.col("size") <= F.col("left"))
        upto = now.withColumn("upto", F.sum(F.when(may, F.col("size")).otherwise(0)).over(inside))
        new = upto.withColumn("new", may & (F.col("upto") <= F.col("left")))
        new = new.withColumn("left", F.col("left") - F.coalesce(F.sum(F.when(F.col("new"), F.col("size"))).over(block), F.lit(0)))
        done, now = now, written(new.withColumn("fits", F.col("fits") | F.col("new")).drop("upto", "new"), "mix-edge")
        discard(done)
    return now


def mix_sources(sized: DataFrame, seed: int = 17, shards: int | None = None) -> DataFrame:
    """One row for each row of sized (doc_id, source, size) that adds source_size, target, repeats, taken, block and draws.

    repeats: how often the mix takes the document (0 to 3); taken = repeats * size. draws: for each time, the output shard whose share of
    the splitting tree drew the document's block, and its position (from 1) in the shard's shuffled order. In the block where a partial
    pass ends, documents that still fit are taken in keyed order, so a source's taken words miss its target by less than a small document.
    Equal inputs give equal mixes. Documents without words have size 0 and come as often as their block. Null sources are one source, last in order. Repeated
    rows are separate documents that share a doc_id, and may be taken alike. An empty table gives no rows. shards: as many as
    hold SHARD_WORDS each (a power of two, LEAST_SHARDS at least) if not given.
    """
    targets = written(source_targets(sized), "mix-targets")
    if shards is None:
        words = targets.agg(F.sum("target")).first()[0] or 0
        shards = max(LEAST_SHARDS, 1 << math.ceil(math.log2(max(1, words / SHARD_WORDS))))
    key = unit_key(seed, F.col("doc_id"), F.col("source"))
    bits = sum((F.col("n_docs") >= 64 << k).cast("int") for k in range(1, BLOCK_BITS + 1))
    rank = targets.select(F.col("source").alias("s"), "rank", "source_size", "target", bits.alias("bits"))
    keyed = sized.select("doc_id", "source", "size").withColumn("key", key).join(rank, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    keyed = written(keyed.withColumn("block", F.expr("shiftright(key, 48 - bits)").cast("int")), "mix-keyed")
    blocks = keyed.groupBy("rank", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    # a pass is whole while words remain; `rest` words are left for the partial pass
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    before = Window.partitionBy("rank").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # 2**BLOCK_BITS rows at most
    blocks = blocks.withColumn("passes", passes).withColumn("left", F.col("target") - F.col("passes") * F.col("source_size") - F.coalesce(F.sum("words").over(before), F.lit(0)))
    blocks = written(blocks.select("rank", "block", "words", "passes", "left"), "mix-blocks")
    times = F.col("passes") + (F.col("left") > 0).cast("int")
    units = blocks.filter(times > 0).select("rank", "block", F.explode(F.sequence(F.lit(0), times - 1)).alias("pass"))
    draws = drawn_blocks(written(units, "mix-units"), shards, seed).groupBy("rank", "block").agg(F.collect_list(F.struct("pass", "shard")).alias("drawn"))
    draws = written(draws, "mix-draws")
    cut = (F.col("left") > 0) & (F.col("words") > F.col("left"))
    ends = blocks.filter(cut).select("rank", "block", "passes", "left")
    edge = fitted(keyed.select("rank", "block", "key", "doc_id", "size").join(ends.select("rank", "block", "left"), ["rank", "block"])).filter("not fits")
    # what doesn't fit the end of the partial pass isn't in it; rows that repeat a document do as the first of them does
    out = edge.groupBy("rank", "key", "doc_id", "size").agg(F.lit(True).alias("out"))
    rows = keyed.join(draws, ["rank", "block"], "left").join(ends.select("rank", "block", "passes"), ["rank", "block"], "left")
    rows = rows.join(out.select("rank", "key", F.col("doc_id").alias("o"), F.col("size").alias("o_size"), "out"), (rows["rank"] == out["rank"]) & (rows["key"] == out["key"]) & rows["doc_id"].eqNullSafe(F.col("o")) & (rows["size"] == F.col("o_size")), "left").select(rows["*"], "out")
    none = F.array().cast("array<struct<pass:int,shard:int>>")
    kept = F.when(F.col("out"), F.filter("drawn", lambda x: x["pass"] < F.col("passes"))).otherwise(F.col("drawn"))
    rows = rows.withColumn("drawn", F.array_sort(F.coalesce(kept, none))).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows.select("row", "doc_id", "source", "key", "size", "source_size", "target", "block", "drawn"), "mix-rows")
    copies = rows.select("row", "doc_id", "key", F.explode("drawn").alias("d")).select("row", "doc_id", "key", "d.pass", "d.shard")
    order = unit_key(seed + 2, F.col("key"), F.col("doc_id"), F.col("pass"))
    placed = numbered(copies.withColumn("shuffled", order), ["shard"], [F.col("shuffled"), F.col("doc_id"), F.col("pass"), F.col("row")], "position")
    draws = placed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "position"))).alias("draws"))
    rows = rows.join(draws, "row", "left").withColumn("draws", F.coalesce("draws", F.array().cast(draws.schema["draws"].dataType)))
    return rows.select("doc_id", "source", "size", "source_size", "target", F.size("draws").alias("repeats"), (F.size("draws") * F.col("size")).alias("taken"), "block", "draws")


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words of the whole text; a null text has none). Other columns are ignored."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def op6_mix_sources(spark, sf_dir: str) -> DataFrame:
    sized = written(sized_documents(spread(table(spark, sf_dir, "documents"))), "mix-sizes")
    out = mix_sources(sized)
    listed = lambda k: F.array_join(F.transform("draws", lambda x: x[k].cast("string")), ",").alias(f"{k}s")
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "repeats", "block", listed("shard"), listed("position"))
