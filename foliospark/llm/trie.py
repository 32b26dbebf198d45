"""Prefix trie of conversations: balanced parentheses in shards of its preorder.

A node is a distinct sequence of first turns. Its identity is a sum of hashes of its turns with their places, so it comes from
running sums, and no conversation is ever gathered. Each node belongs to its longest member (the smallest of equally long ones),
which divides the trie into paths; a path hangs on another at some depth. The way of such joints from the root, deeper joints first, sorts nodes into
preorder, and any way has few joints (a trie of n nodes has none with more than about sqrt(2 n)). Shards are ranges of the preorder.

A shard writes its nodes as a parenthesis sequence with the excess after each; blocks of excess minima in doubling sizes find the closing
parenthesis of every node (findclose), which delimits its subtree. Ranks of "()" count leaves, cumulative arrays give savings. A node that stays
open at its shard's end (the spine that later shards share) closes in the first later shard that goes as low; what each shard's running
minima say before that place is added.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.numbering import running_sums
from foliospark.session import discard, table, written

SHARD_NODES, SHARDS = 50_000, 65_536  # nodes of a shard at least, shards at most
ENDS = 4096  # numbers of conversations whose ends are joined at once
EMPTY = hashlib.sha256(b"").hexdigest()
PARTS = ("p1", "p2", "p3", "p4")  # of a node's identity: four sums of 32-bit halves of two hashes
KEY = [*PARTS, "depth"]


class MinTree:
    """Minima of blocks of 1, 2, 4, ... values: the first place from a start on whose value is a limit at most, for whole arrays."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.size = 1 << max(1, (self.n - 1).bit_length())
        self.least = np.full(2 * self.size, np.iinfo(np.int64).max, np.int64)
        self.least[self.size : self.size + self.n] = values
        low = self.size
        while low > 1:
            self.least[low // 2 : low] = self.least[low : 2 * low].reshape(-1, 2).min(axis=1)
            low //= 2

    def first(self, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """n where there is none."""
        out = np.full(len(start), self.n, np.int64)
        todo = np.flatnonzero(start < self.n)
        node, most = start[todo] + self.size, limit[todo]
        while len(todo):
            node //= node & -node  # the largest block that begins there
            hit = self.least[node] <= most
            found, bound, at = node[hit], most[hit], todo[hit]
            while (found < self.size).any():
                inner = found < self.size
                left = found[inner] * 2
                found[inner] = left + (self.least[left] > bound[inner])
            out[at] = found - self.size
            node = node[~hit] + 1
            go = (node & (node - 1)) != 0  # else it was the last block
            todo, most, node = todo[~hit][go], most[~hit][go], node[go]
        return out


class Parentheses:
    """The nodes of a run of the preorder, by their depths. Nodes opened before the run are not written; those open at its end are not closed."""

    def __init__(self, depth: np.ndarray, last_is_leaf: bool):
        n = len(depth)
        low = np.minimum.accumulate(depth)
        closes = np.zeros(n + 1, np.int64)  # before each node, and at the end
        closes[1:n] = depth[:-1] - np.maximum(depth[1:], low[:-1]) + 1
        closes[n] = last_is_leaf
        self.open = np.arange(n) + np.cumsum(closes[:-1])
        up = np.zeros(n + int(closes.sum()), bool)
        up[self.open] = True
        excess = np.cumsum(np.where(up, 1, -1))
        self.close = MinTree(excess).first(self.open + 1, excess[self.open] - 1)  # len(up) where it is open
        self.closed = self.close < len(up)
        self.rank = np.r_[0, np.cumsum(up)]  # nodes opened before a place
        pairs = np.zeros(len(up), bool)
        pairs[:-1] = up[:-1] & ~up[1:]
        self.leaf_rank = np.r_[0, np.cumsum(pairs)]
        self.records = np.flatnonzero(np.r_[True, depth[1:] < low[:-1]]) if n else np.zeros(0, np.int64)

    def leaves(self) -> np.ndarray:
        return self.leaf_rank[self.close] - self.leaf_rank[self.open]

    def after(self) -> np.ndarray:
        """The first node after each subtree."""
        return self.rank[self.close]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1, by turn, null first, then role and text), total (of the conversation's turns), h1, h2 (hashes of role and text) and n_words.

    Rows with a null conv_id take no part; a null role or text is empty. Rows are dealt by ranges, so a long conversation is many tasks'.
    """
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    cut = written(cut.select("conv_id", *(F.xxhash64(F.lit(k), "role", "text").alias(f"h{k}") for k in (1, 2)), words.alias("n_words"), F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "trie-turns")
    spans = cut.groupBy("range", "conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    by = Window.partitionBy("conv_id")  # one row a range
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(by.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("n").over(by))
    return cut.join(spans.drop("n"), ["range", "conv_id"]).select("conv_id", (F.col("at") - F.col("first") + 1 + F.col("before")).alias("place"), "total", "h1", "h2", "n_words")


def rebuilt(turns: DataFrame, base: Column, share: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) where each conversation begins with the first `share` turns of another, `base`, in place of its own.

    turns: as turn_rows gives them. base and share are expressions on conv_id; share is `most` at most. A base without so many turns gives those that it has, an absent one none.
    The first result has conv_id, depth, length, h1, h2 and n_words, the second conv_id and length of every conversation, turnless ones too.
    """
    totals = turns.filter("place = 1").select("conv_id", "total").withColumn("base", base).withColumn("share", share)
    bases = totals.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    convs = totals.join(bases, "base", "left").withColumn("lent", F.least("share", F.coalesce("base_total", F.lit(0))))
    convs = written(convs.select("conv_id", "base", "share", "lent", (F.col("lent") + F.greatest(F.col("total") - F.col("share"), F.lit(0))).alias("length")), "trie-conversations")
    own = turns.join(convs.drop("base"), "conv_id").filter("place > share").select("conv_id", (F.col("place") - F.col("share") + F.col("lent")).alias("depth"), "length", "h1", "h2", "n_words")
    heads = turns.filter(F.col("place") <= most).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "h1", "h2", "n_words")
    lent = convs.filter("lent > 0").join(heads, "base").filter("depth <= lent").select("conv_id", "depth", "length", "h1", "h2", "n_words")
    return own.unionByName(lent), convs.select("conv_id", "length")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one node after the other, in order, become the digest of their join by commas; only a digest is kept between rows."""
    key, state, keys, out = None, None, [], []

    def named() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*keys, strict=True)), pa.array(out, pa.string())], [*KEY, "ends_sha256"])

    for batch in batches:
        for *node, text in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
            if node != key:
                if key is not None:
                    keys.append(key)
                    out.append(state.hexdigest())
                key, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if len(keys) > 5000:
            yield named()
            keys, out = [], []
    if key is not None:
        keys.append(key)
        out.append(state.hexdigest())
        yield named()


def end_digests(ends: DataFrame) -> DataFrame:
    """ends_sha256 of each node: the conversations that end there (conv_id, beside KEY), joined in runs of numbers first and then one run after the other."""
    runs = ends.groupBy(*KEY, F.floor(F.col("conv_id") / ENDS).cast("long").alias("run")).agg(F.array_sort(F.collect_list("conv_id")).alias("c"))
    texts = runs.select(*KEY, "run", F.array_join(F.transform("c", lambda x: x.cast("string")), ",").alias("ids"))
    return texts.repartition(*KEY).sortWithinPartitions(*KEY, "run").mapInArrow(_digests, ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string")


def trie_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node with its members, children, parent, the digest of those that end there, and the member whose path it is on (owner, parent_owner); written."""
    halves = [(F.xxhash64(F.lit(k), "depth", "h1", "h2"), half) for k in (3, 4) for half in (0, 1)]
    part = lambda h, half: F.shiftrightunsigned(h, 32) if half else h.bitwiseAND(F.lit(0xFFFFFFFF))
    steps = turns.select("conv_id", "depth", "length", "n_words", *(part(*h).alias(f"a{i}") for i, h in enumerate(halves, 1)))
    whole = running_sums(steps, ["conv_id"], [F.col("depth")], {p: F.col(f"a{i}") for i, p in enumerate(PARTS, 1)})
    up = [(F.col(p) - F.col(f"a{i}")).alias(f"q{i}") for i, p in enumerate(PARTS, 1)]
    top = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", F.lit(0).cast("long").alias("n_words"), *(F.lit(0).cast("long").alias(c) for c in (*PARTS, "q1", "q2", "q3", "q4")))
    rows = written(whole.select("conv_id", "depth", "length", "n_words", *PARTS, *up).unionByName(top), "trie-rows")
    longest = F.max(F.struct("length", (-F.col("conv_id")).alias("c")))
    nodes = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_words").alias("n_words"), longest.alias("o"), *(F.max(f"q{i}").alias(f"q{i}") for i in range(1, 5)))
    nodes = written(nodes.withColumn("owner", -F.col("o.c")).drop("o"), "trie-members")
    above = [*(F.col(f"q{i}").alias(p) for i, p in enumerate(PARTS, 1)), (F.col("depth") - 1).alias("depth")]
    children = nodes.filter("depth > 0").groupBy(*above).agg(F.count("*").alias("n_children"))
    parents = nodes.select(*(F.col(p).alias(f"q{i}") for i, p in enumerate(PARTS, 1)), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("owner").alias("parent_owner"))
    out = nodes.join(children, KEY, "left").join(end_digests(rows.filter("depth = length").select("conv_id", *KEY)), KEY, "left").join(parents, ["q1", "q2", "q3", "q4", "depth"], "left")
    out = written(out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), "owner", "parent_owner"), "trie-nodes")
    discard(rows, nodes)
    return out


def preorder(nodes: DataFrame) -> DataFrame:
    """conv_id, depth, saved and n_children of all nodes in shards (shard, at) of the preorder; written.

    The way of joints to each path is put together by doubling: as many joins as the logarithm of the longest way.
    """
    own = nodes.filter("depth = 0 or owner <> parent_owner")
    joint = F.when(F.col("depth") > 0, F.array(1 - F.col("depth"), F.col("owner"))).otherwise(F.array().cast("array<bigint>"))
    paths = written(own.select("owner", F.col("parent_owner").alias("up"), joint.alias("way")), "trie-paths")
    while not paths.filter("up is not null").isEmpty():
        far = paths.select(F.col("owner").alias("up"), F.col("up").alias("next"), F.col("way").alias("before"))
        longer = paths.join(far, "up", "left").select("owner", F.col("next").alias("up"), F.concat(F.coalesce("before", F.array().cast("array<bigint>")), "way").alias("way"))
        done, paths = paths, written(longer, "trie-paths")
        discard(done)
    shards = min(SHARDS, math.ceil(nodes.count() / SHARD_NODES)) or 1
    keyed = nodes.select("conv_id", "depth", "saved", "n_children", "owner").join(paths.select("owner", "way"), "owner")
    ordered = keyed.repartitionByRange(shards, "way", "depth").sortWithinPartitions("way", "depth")
    return written(ordered.select("conv_id", "depth", "saved", "n_children", F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("at")), "trie-preorder")


CLOSED, OPEN, RECORD, SHARD = range(4)


def _shard(rows: pa.Table) -> pa.Table:
    """What one shard knows: its nodes' sums, whole (CLOSED) or up to its end (OPEN), its running minima with the sums before them (RECORD), and its lowest depth with its sums (SHARD)."""
    names = ["kind", "conv_id", "depth", "below", "leaves", "saved", "shard"]
    at = np.argsort(rows.column("at").to_numpy(), kind="stable")
    conv, depth, saved = (rows.column(c).to_numpy()[at] for c in ("conv_id", "depth", "saved"))
    shard, n = rows.column("shard")[0].as_py(), len(at)
    p = Parentheses(depth, bool(rows.column("n_children").to_numpy()[at[-1]] == 0))
    sums = np.r_[0, np.cumsum(saved)]
    lows = depth[p.records]
    below = np.r_[np.iinfo(np.int64).max, lows[:-1]]
    zero = np.zeros(1, np.int64)
    columns = [
        np.r_[np.where(p.closed, CLOSED, OPEN), np.full(len(lows), RECORD), [SHARD]],
        np.r_[conv, np.zeros(len(lows) + 1, np.int64)],
        np.r_[depth, lows, lows[-1:]],
        np.r_[np.zeros(n, np.int64), below, zero],
        np.r_[p.leaves(), p.leaf_rank[p.open[p.records]], p.leaf_rank[-1:]],
        np.r_[sums[p.after()] - sums[:-1], sums[p.records], sums[-1:]],
        np.full(n + len(lows) + 1, shard),
    ]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=names)


def subtree_sums(ordered: DataFrame) -> DataFrame:
    """conv_id, depth, n_leaves and saved_tokens of every node. The driver sees four numbers of each shard, and there are SHARDS of them at most."""
    schema = "kind long, conv_id long, depth long, below long, leaves long, saved long, shard long"
    found = written(ordered.groupBy("shard").applyInArrow(_shard, schema), "trie-shards")
    of = sorted((r["shard"], r["depth"], r["leaves"], r["saved"]) for r in found.filter(F.col("kind") == SHARD).collect())
    numbers, lowest, leaves, saved = (np.array(c, np.int64) for c in zip(*of, strict=True)) if of else [np.zeros(0, np.int64)] * 4
    cumulative = [np.r_[0, np.cumsum(x)] for x in (leaves, saved)]

    def closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = MinTree(lowest)
        for batch in batches:
            depth, shard = batch.column("depth").to_numpy(), batch.column("shard").to_numpy()
            start = np.searchsorted(numbers, shard) + 1
            at = tree.first(start, depth)
            more = [batch.column(c).to_numpy() + x[at] - x[start] for c, x in zip(("leaves", "saved"), cumulative, strict=True)]
            closes_in = np.r_[numbers, -1][at]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("depth"), *map(pa.array, more), pa.array(closes_in)], ["conv_id", "depth", "leaves", "saved", "closes_in"])

    spine = found.filter(F.col("kind") == OPEN).select("conv_id", "depth", "leaves", "saved", "shard").mapInArrow(closing, "conv_id long, depth long, leaves long, saved long, closes_in long")
    records = found.filter(F.col("kind") == RECORD).select(F.col("shard").alias("closes_in"), F.col("depth").alias("from"), "below", F.col("leaves").alias("l"), F.col("saved").alias("s"))
    met = (spine["closes_in"] == records["closes_in"]) & (F.col("depth") >= F.col("from")) & (F.col("depth") < F.col("below"))
    merged = spine.join(records, met, "left").select("conv_id", "depth", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"))
    return found.filter(F.col("kind") == CLOSED).select("conv_id", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")).unionByName(merged)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    turns: conv_id, depth (from 1), length (of the conversation), h1, h2, n_words; convs: conv_id and length of each, turnless ones too. No conversations give no nodes.
    """
    nodes = trie_nodes(turns, convs)
    sums = subtree_sums(preorder(nodes))
    return nodes.join(sums, ["conv_id", "depth"]).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    share = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("long")
    turns = turn_rows(conversations)
    return prefix_trie(*rebuilt(turns, F.col("conv_id") - F.col("conv_id") % 20, share, most=3))


#: The low bits of a number's CRC-32 come from its bits one by one.
ORACLE = r"""WITH ids AS (SELECT DISTINCT conv_id, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda i: ((ascii(c) >> i) & 1)::BIGINT))) AS bits FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)), 4294967295) % 4 AS h FROM ids),
t AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS w FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (SELECT t.conv_id, list_concat(coalesce(x.w[1:h], []), t.w[h + 1:]) AS w FROM t JOIN h USING (conv_id) LEFT JOIN t x ON x.conv_id = t.conv_id - t.conv_id % 20),
e AS (SELECT conv_id, w, unnest(range(len(w) + 1)) AS d FROM b),
node AS MATERIALIZED (SELECT w[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs, count(DISTINCT conv_id) - 1 AS spare, max(CASE WHEN d > 0 THEN len(regexp_extract_all(w[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END) AS words,
  sha256(coalesce(string_agg(CASE WHEN len(w) = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM e GROUP BY 1, 2),
kids AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
up AS (SELECT p, d, spare * words AS s, unnest(range(d + 1)) AS a, d NOT IN (SELECT k.d FROM kids k WHERE k.p = node.p) AS leaf FROM node),
below AS (SELECT p[1:a] AS p, a AS d, sum(s) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM up GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON n.d = b.d AND n.p = b.p LEFT JOIN kids k ON n.d = k.d AND n.p = k.p LEFT JOIN node m ON m.d = n.d - 1 AND m.p = n.p[1:n.d - 1]"""
