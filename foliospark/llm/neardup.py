"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

Documents are sets of word shingles. Rows with equal sets become one class, represented by its smallest doc_id. Several
independent trees then branch the representatives: a node sends each of its members to the children of the minwise tokens
that it has at coordinates chosen by the node. A pair at the limit shares nearly all roots, so a representative that meets others in too few
of them has no partner and goes no further. Nodes of at most `limit` members are compared exhaustively, one of those with the same members. Members of larger ones
are compared with a few pivots of their block first; what is linked, by links confirmed on the full shingle sets, is one
component from then on. A node whose members are all of one component is done; where at most CROWD are of others, those are compared
with each other and with the whole component, once, whose members needn't come to the node for that; any other node branches on. So sketches only nominate pairs, and the only pairs that are left out are those whose
ends confirmed links have joined already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm.graph import connected_components
from foliospark.llm.textbytes import Texts, freed, mix, shingles, slices
from foliospark.session import discard, spread, table, written

COORDINATES = 128
ROOTS_PER_TREE = 2
_rng = np.random.Generator(np.random.PCG64(7))
_MULTIPLIERS = _rng.integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _rng.integers(1, 2**63, 1024, dtype=np.uint64)
PIVOTS = 8  # that the members of a block of a large node are compared with
STARS = 3  # of so many large nodes a member comes to one, by key, to nominate its likeliest pivot: it is in many, and what has no label yet goes on
BLOCK = 2048  # members of a large node for each place where they are compared, about; of these, those come that nominate
CROWD = 1024  # outsiders of a node that are compared with all of its members: branching would part them, but makes many rows of each member
PAIRS = "a long, b long, ask boolean, hub boolean"
FEW, MANY, CROWDED = range(3)  # kinds of nodes
FIRST, AGAIN = -1, -2  # places of outsiders in the first block of their group, where they meet each other, and in its others
CHILDREN_OF_LEVEL = (5, 16)  # of a node, at most and the last for all deeper levels: the more, by the more coordinates a child is chosen, and the sooner pairs below the limit part
EXPECTED_CHILDREN = 1.1  # in which a pair at the limit meets again, at least: above 1, so that it may meet at any depth
RECALL = 0.99  # chance that the trees nominate a pair at the limit, whatever depth its nodes reach
LEAST_TREES = 8
ALONE = 1e-4  # chance, at most, that a pair at the limit shares too few root nodes to be looked at: small beside what RECALL allows
DEEPEST = 12  # level of nodes whose members can't be told apart by branching: those are compared in full, block by block


def steps(percent: int) -> list[tuple[int, int]]:
    """(coordinates, children) of each level, the last for all deeper ones."""
    s = min(percent, 99) / 100
    coordinates = [max(1, math.floor(math.log(c / EXPECTED_CHILDREN) / -math.log(s))) for c in CHILDREN_OF_LEVEL]
    return [(k, math.ceil(EXPECTED_CHILDREN / s**k)) for k in coordinates]


def meeting_chance(percent: int, depth: int = DEEPEST) -> float:
    """Chance that a pair at the limit shares a root node and a line of nodes from it down to `depth`: the survival of a branching process."""
    plan, s, alive = steps(percent), percent / 100, 1.0
    for level in reversed(range(depth)):
        k, children = plan[min(level, len(plan) - 1)]
        alive = 1 - (1 - s**k * alive) ** children
    return s * alive


def needed_trees(percent: int) -> int:
    """Independent trees for the target RECALL at DEEPEST, where nodes are compared in full."""
    alone = 1 - meeting_chance(percent)
    roots = math.ceil(math.log(1 - RECALL) / math.log(alone)) if alone > 0 else 1
    return max(LEAST_TREES, -(-roots // ROOTS_PER_TREE))


def least_shared(percent: int, roots: int) -> int:
    """Root nodes of `roots` that the two of a pair at the limit share, but for a chance of ALONE: each of them with the pair's similarity."""
    s, missed = percent / 100, 0.0
    for k in range(roots):
        missed += math.comb(roots, k) * s**k * (1 - s) ** (roots - k)
        if missed > ALONE:
            return k
    return roots


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Smaller Arrow batches for the jobs inside, whose rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _distinct_shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending inside each text, bounds of each text)."""
    values, of = shingles(Texts(data, offsets, lower=True), width)
    n = len(offsets) - 1
    bounds = np.searchsorted(of, np.arange(n + 1))
    for d in np.flatnonzero(np.diff(bounds) > 1):
        values[bounds[d] : bounds[d + 1]].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    values, of = values[new], of[new]
    return values, np.searchsorted(of, np.arange(n + 1))


def sketches(docs: DataFrame, width: int, trees: int) -> DataFrame:
    """doc_id, n_shingles, two 64-bit digests of the set, the root nodes of all trees and a signature of 8-bit minwise tokens."""
    roots = trees * ROOTS_PER_TREE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                values, bounds = _distinct_shingles(data, offsets, width)
                sizes = np.diff(bounds)
                some = np.flatnonzero(sizes)
                at = bounds[some]
                least = np.zeros((hi - lo, roots + COORDINATES), np.uint64)
                h1, h2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                if len(some):
                    hold = np.empty_like(values)
                    with np.errstate(over="ignore"):
                        for c in range(roots + COORDINATES):
                            np.multiply(values, _MULTIPLIERS[c], out=hold)
                            np.add(hold, _ADDENDS[c], out=hold)
                            least[some, c] = np.minimum.reduceat(hold, at)
                        h1[some] = np.add.reduceat(mix(values), at)
                        h2[some] = np.add.reduceat(mix(values ^ _ADDENDS[-1]), at)
                        least[:, :roots] = mix(least[:, :roots] + np.arange(1, roots + 1, dtype=np.uint64) * _MULTIPLIERS[-1])
                tokens = (mix(least[:, roots:]) & np.uint64(0xFF)).astype(np.uint8)
                nodes = pa.ListArray.from_arrays(np.arange(hi - lo + 1, dtype=np.int32) * roots, pa.array(least[:, :roots].astype(np.int64).ravel()))
                sig = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(np.arange(hi - lo + 1, dtype=np.int32) * COORDINATES), pa.py_buffer(tokens.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], pa.array(sizes.astype(np.int64)), pa.array(h1.astype(np.int64)), pa.array(h2.astype(np.int64)), nodes, sig],
                    ["doc_id", "n_shingles", "h1", "h2", "nodes", "sig"],
                )

    return docs.select("doc_id", "text").mapInArrow(freed(run), "doc_id long, n_shingles long, h1 long, h2 long, nodes array<long>, sig binary")


def _tokens(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, _, data = column.buffers()
    return np.frombuffer(data, np.uint8, count=len(column) * COORDINATES, offset=column.offset * COORDINATES).reshape(-1, COORDINATES)


def _pairs(a: np.ndarray, b: np.ndarray, ask: bool) -> pa.RecordBatch:
    """Pairs of documents, the smaller first, or (ask) a document and a component that it is to meet. hub: whether the smaller one came second, as what many others are compared with."""
    hub = (b < a) & (not ask)
    a, b = (a, b) if ask else (np.minimum(a, b), np.maximum(a, b))
    both = np.unique(np.stack([a, b, hub.astype(np.int64)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.full(len(both), ask)), pa.array(both[:, 2] > 0)], ["a", "b", "ask", "hub"])


NONE = np.iinfo(np.int64).min  # pads lists of nodes


def _padded(column: pa.Array) -> np.ndarray:
    """Lists of nodes as rows of one width."""
    counts = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), counts.max(initial=0)), NONE)
    out[np.arange(out.shape[1]) < counts[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _below(parts: tuple[np.ndarray, ...]) -> np.ndarray:
    if parts[0].ndim == 2:
        width = max(x.shape[1] for x in parts)
        parts = tuple(np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=NONE) if x.shape[1] < width else x for x in parts)
    return np.concatenate(parts)


class _Rows:
    """Rows of nodes, in order of their blocks, with what can link two of them; full: all nodes of the row's member that compare all of their pairs, in order."""

    NAMES = "node block kind place rep n label crowd sig full".split()

    def __init__(self, columns: list[np.ndarray], percent: int, least: int):
        self.columns, self.percent, self.least = columns, percent, least
        self.node, self.block, self.kind, self.place, self.rep, self.n, self.label, self.crowd, self.sig, self.full = columns

    @classmethod
    def of(cls, batch: pa.RecordBatch, *limits: int) -> _Rows:
        return cls([*(batch.column(k).to_numpy(zero_copy_only=False) for k in cls.NAMES[:-2]), _tokens(batch.column("sig")), _padded(batch.column("full"))], *limits)

    def after(self, earlier: list[np.ndarray]) -> _Rows:
        return _Rows([_below(x) for x in zip(earlier, self.columns, strict=True)], self.percent, self.least)

    def at(self, rows: np.ndarray | slice) -> list[np.ndarray]:
        return [x[rows].copy() for x in self.columns]

    def matches(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """At how many coordinates i and j agree; -1 where they can't be linked or are joined already."""
        out = np.full(len(i), -1, np.int32)
        a, b = self.n[i], self.n[j]
        fit = np.flatnonzero((self.rep[i] != self.rep[j]) & (self.label[i] != self.label[j]) & (100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)))
        for k in range(0, len(fit), 20000):
            at = fit[k : k + 20000]
            out[at] = (self.sig[i[at]] == self.sig[j[at]]).sum(axis=1)
        out[out < self.least] = -1
        return out

    def here(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether no node before this one compares i and j as well: a pair that meets in many nodes is nominated in one."""
        out = np.ones(len(i), bool)
        for k in range(0, len(i), 20000):
            at = np.arange(k, min(k + 20000, len(i)))
            for c in range(self.full.shape[1]):
                node = self.full[i[at], c]
                at, node = at[node < self.node[i[at]]], node[node < self.node[i[at]]]
                at, node = at[node != NONE], node[node != NONE]
                met = (self.full[j[at]] == node[:, None]).any(axis=1)
                out[at[met]] = False
                at = at[~met]
                if not len(at):
                    break
        return out


def _nominated(rows: DataFrame, percent: int, limit: int, least: int) -> DataFrame:
    """(a, b, ask) of members of one node whose signatures agree at `least` coordinates and that have different labels.

    All pairs of a node of few members; a row of a larger one and the likeliest of the first PIVOTS rows of its block. In a crowded node
    outsiders lead (negative place) each block: pairs of outsiders, once, and each outsider with the label of those of the crowd that are there, as what it is to meet. What meets in several small or crowded
    nodes is nominated in the first of them. A task keeps a few rows at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = leading = None
        for batch in batches:
            rows_ = _Rows.of(batch, percent, least)
            found, asked = [], []
            few = rows_.at(rows_.kind == FEW)
            if len(few[0]):
                t = _Rows(few, percent, least) if recent is None else _Rows(few, percent, least).after(recent)
                for d in range(1, limit):
                    i = np.flatnonzero(t.node[d:] == t.node[:-d])
                    near = i[t.matches(i, i + d) >= 0]
                    near = near[t.here(near, near + d)]
                    found.append((t.rep[near], t.rep[near + d]))
                recent = t.at(slice(max(0, len(t.node) - limit), None))
            large = rows_.at(rows_.kind != FEW)
            if len(large[0]):
                t = _Rows(large, percent, least) if leading is None else _Rows(large, percent, least).after(leading)
                new = np.r_[True, (t.node[1:] != t.node[:-1]) | (t.block[1:] != t.block[:-1])]
                number = np.cumsum(new) - 1
                first = np.flatnonzero(new)
                order = np.arange(len(t.node)) - first[number]
                leads = np.where(t.kind == CROWDED, t.place < 0, order < PIVOTS)
                n_leads = np.bincount(number[leads], minlength=len(first))[number]
                best, of = np.full(len(t.node), -1, np.int32), np.zeros(len(t.node), np.int64)
                for p in range(int(n_leads.max(initial=0))):
                    i = np.flatnonzero((n_leads > p) & np.where(t.kind == CROWDED, (order > p) & (t.place != AGAIN), order != p))
                    j = first[number[i]] + p
                    m = t.matches(i, j)
                    met = np.flatnonzero((m >= 0) & (t.kind[i] == CROWDED))
                    met = met[t.here(i[met], j[met])]
                    inside = t.label[i[met]] == t.crowd[i[met]]
                    asked.append((t.rep[j[met[inside]]], t.crowd[j[met[inside]]]))
                    found.append((t.rep[i[met[~inside]]], t.rep[j[met[~inside]]]))
                    more = (m > best[i]) & (t.kind[i] == MANY)
                    best[i[more]], of[i[more]] = m[more], j[more]
                one = np.flatnonzero(best >= 0)
                found.append((t.rep[one], t.rep[of[one]]))
                leading = t.at(np.flatnonzero(leads & (number == number[-1])))
            for ask, rows_of in ((False, found), (True, asked)):
                if rows_of:
                    yield _pairs(*(np.concatenate(x) for x in zip(*rows_of, strict=True)), ask)

    dealt = rows.select(*_Rows.NAMES).repartition("node", "block").sortWithinPartitions("node", "block", "place", "rep")
    return dealt.mapInArrow(freed(run), PAIRS).groupBy("a", "b", "ask").agg(F.max("hub").alias("hub"))


def _branch(rows: DataFrame, step: int, children: int) -> DataFrame:
    """(node, rep, label) of the children of rows (node, rep, label, sig): a child is chosen by the tokens at `step` coordinates that the node selects. Members keep the labels that they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed = batch.column("node").to_numpy(zero_copy_only=False).astype(np.uint64)
            sig = _tokens(batch.column("sig"))
            each = np.arange(len(sig))
            with np.errstate(over="ignore"):
                for child in range(children):
                    node = mix(seed + _MULTIPLIERS[5] * np.uint64(child + 1))
                    at = node
                    for _ in range(step):
                        at = mix(at + _ADDENDS[1])
                        coordinate = (at % np.uint64(COORDINATES)).astype(np.int64)
                        node = mix(node * _MULTIPLIERS[3] + sig[each, coordinate].astype(np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int64)), batch.column("rep"), batch.column("label")], ["node", "rep", "label"])

    return rows.select("node", "rep", "label", "sig").mapInArrow(run, "node long, rep long, label long")


def _roots(reps: DataFrame, percent: int, roots: int, limit: int) -> DataFrame:
    """The root nodes (node, rep, label, members, crowd, outside) of reps (rep, nodes), every representative a component of its own; written.

    A pair at the limit shares least_shared of its roots, so what meets anyone in fewer is left out. Of nodes with the same few members, which are compared alike, one stays.
    """
    rows = reps.select("rep", F.explode(F.array_distinct("nodes")).alias("node"))
    met = rows.groupBy("node").agg(F.count("*").alias("members")).filter("members > 1").select("node")
    shared = rows.join(met, "node").select("node", "rep", F.count("*").over(Window.partitionBy("rep")).alias("shared"))
    some = written(shared.filter(F.col("shared") >= least_shared(percent, roots)).select("node", "rep"), "near-roots")
    who = (F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"who{k}") for k in (0, 1))
    counts = some.groupBy("node").agg(F.count("*").alias("members"), *who).filter("members > 1")
    one = counts.groupBy("members", "who0", "who1", F.when(F.col("members") > limit, F.col("node")).alias("large")).agg(F.min("node").alias("node")).select("node", "members")
    out = written(some.join(one, "node").select("node", "rep", F.col("rep").alias("label"), "members", F.lit(-1).cast("long").alias("crowd"), (F.col("members") - 1).alias("outside")), "near-nodes")
    discard(some)
    return out


def _labelled(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """rows (node, rep) of nodes whose members have several labels, with the `label` of their component, `members` of the node, its most frequent label `crowd`, and `outside`: how many are of others; written.

    rows may have labels already (children have their parents', under the same components); else found gives them.
    """
    own = None
    if found is not None:
        labels = rows.select("node", "rep").join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
        rows = own = written(labels.select("node", "rep", F.coalesce("component", "rep").alias("label")), "near-labels")
    each = rows.groupBy("node", "label").agg(F.count("*").alias("n"))
    crowds = each.groupBy("node").agg(F.sum("n").alias("members"), F.max(F.struct("n", "label")).alias("crowd"))
    crowds = crowds.select("node", "members", F.col("crowd.label").alias("crowd"), (F.col("members") - F.col("crowd.n")).alias("outside")).filter("outside > 0")  # a node of one member has none
    out = written(rows.select("node", "rep", "label").join(crowds, "node").select("node", "rep", "label", "members", "crowd", "outside"), "near-nodes")
    if own is not None:
        discard(own)
    return out


def _kind(limit: int, level: int) -> F.Column:
    crowded = (F.lit(level) > 0) & (F.col("outside") <= CROWD) | F.lit(level >= DEEPEST)
    return F.when(F.col("members") <= limit, FEW).when(crowded, CROWDED).otherwise(MANY)


def _by_name() -> F.Column:
    """Whether a crowded node has more members of its crowd than outsiders: these ask for the crowd by its label then, and its members, which are in many such nodes, stay away."""
    return F.col("members") > 2 * F.col("outside")


def _full(rows: DataFrame, limit: int, level: int) -> DataFrame:
    """rows with `full`: in order, their member's nodes that compare all pairs. None at the roots, where of small nodes with the same members one has stayed."""
    if level == 0:
        return rows.withColumn("full", F.array().cast("array<long>"))
    whole = rows.filter(_kind(limit, level) != MANY)
    return rows.join(whole.groupBy("rep").agg(F.sort_array(F.collect_list("node")).alias("full")), "rep", "left").withColumn("full", F.coalesce("full", F.array().cast("array<long>")))


def _dealt(rows: DataFrame, limit: int, level: int) -> DataFrame:
    """rows with kind, block and place. Large nodes fall into blocks, where of STARS rows one stays; in a crowded one, groups of outsiders lead copies of all blocks.

    Its crowd is left out where outsiders ask for it by name.
    """
    rows = rows.withColumn("kind", _kind(limit, level)).withColumn("place", F.pmod(F.xxhash64("rep", "node", F.lit(-level)), F.lit(1 << 30)))
    rows = rows.filter((F.col("kind") != MANY) | (F.col("place") % STARS == 0))
    parts = F.ceil(F.when((F.col("kind") == CROWDED) & _by_name(), F.col("outside")).otherwise(F.col("members")) / BLOCK)
    rows = rows.withColumn("block", F.when(F.col("kind") == FEW, F.lit(0)).otherwise(F.pmod(F.xxhash64("rep", "node", F.lit(level)), parts)).cast("long"))
    if level == 0:
        return rows
    crowded = rows.filter(F.col("kind") == CROWDED).withColumn("groups", F.ceil(F.col("outside") / CROWD)).withColumn("parts", parts)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    members = crowded.filter(F.when(F.col("label") == F.col("crowd"), ~_by_name()).otherwise(F.col("groups") > 1)).withColumn("group", upto("groups") if level >= DEEPEST else F.lit(0).cast("long"))  # above, outsiders are few; those of one group meet each other as its leads
    own = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("groups"))
    leads = crowded.filter("label <> crowd").withColumn("group", own).withColumn("block", upto("parts")).withColumn("place", F.when(F.col("block") == 0, FIRST).otherwise(AGAIN).cast("long"))
    both = members.unionByName(leads.select(members.columns)).withColumn("block", F.col("block") + F.col("group") * F.col("parts"))
    return rows.filter(F.col("kind") != CROWDED).unionByName(both.select(rows.columns))


LEADS, MET = 1 << 21, 1 << 20  # shingles of the outsiders and of the members of a component that meet in one place, about


class _Leads:
    """Outsiders [rep, n, signature, set] of one place, met by one member after the other."""

    def __init__(self, leads: list[tuple]):
        self.reps, self.sizes, self.signs = np.array([x[0] for x in leads]), np.array([x[1] for x in leads]), np.array([x[2] for x in leads])
        self.open = np.ones(len(leads), bool)
        values, of = np.concatenate([x[3] for x in leads]), np.repeat(np.arange(len(leads)), [len(x[3]) for x in leads])
        order = np.argsort(values, kind="stable")
        self.values, self.of = values[order], of[order]

    def linked(self, rep: int, n: int, sig: np.ndarray, raw: pa.Scalar, percent: int, least: int) -> list[int]:
        """The outsiders without a link yet that are linked with this member, by their whole sets."""
        near = self.open & (self.reps != rep) & ((self.signs == sig).sum(axis=1) >= least) & (100 * np.minimum(self.sizes, n) >= percent * np.maximum(self.sizes, n))
        if not near.any():
            return []
        members = _members(raw.as_buffer())
        lo, hi = np.searchsorted(self.values, members, "left"), np.searchsorted(self.values, members, "right")
        some = hi > lo
        lo, count = lo[some], (hi - lo)[some]
        places = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        common = np.bincount(self.of[places], minlength=len(self.reps))
        done = near & (common > 0) & (100 * common >= percent * (self.sizes + n - common))
        self.open &= ~done
        return self.reps[done].tolist()


def _component_links(asks: DataFrame, found: DataFrame, here: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int, least: int) -> DataFrame:
    """(a, b): for each outsider `rep` and component `target` of asks, a link to each block of the component that has one, found on the full sets.

    The outsiders of a component, in groups, come before the members of each of its blocks; an outsider that has found its link needs no other there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leads, index = None, [], None  # the place, its outsiders, and where their shingles stand
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in ("target", "group", "block")), strict=True)
            n, sig = batch.column("n").to_numpy(zero_copy_only=False), _tokens(batch.column("sig"))
            links = []
            for i, (key, lead, rep, raw) in enumerate(zip(keys, batch.column("lead").to_pylist(), batch.column("rep").to_pylist(), batch.column("members"), strict=True)):
                if key != at:
                    at, leads, index = key, [], None
                if lead:
                    leads.append((rep, n[i], sig[i].copy(), _members(raw.as_buffer()).copy()))
                elif leads:
                    index = index or _Leads(leads)
                    links += [(min(x, rep), max(x, rep)) for x in index.linked(rep, n[i], sig[i], raw, percent, least)]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    asks = asks.join(here, "rep")
    asked = asks.groupBy("target").agg(F.sum("n").alias("asked"))
    own = found.select(F.col("id").alias("rep"), F.col("component").alias("target")).join(asked.select("target"), "target", "left_semi").unionByName(asked.select(F.col("target").alias("rep"), "target"))
    own = own.join(_likely(sigs, own.select("rep"), "rep"), "rep")
    sizes = own.groupBy("target").agg(F.sum("n").alias("size")).join(asked, "target")
    sizes = sizes.select("target", F.ceil(F.col("asked") / LEADS).alias("groups"), F.ceil(F.col("size") / MET).alias("blocks"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    dealt = lambda c: F.pmod(F.xxhash64("rep", "target"), F.col(c))
    members = own.join(sizes, "target").select("rep", "n", "sig", "target", F.lit(False).alias("lead"), upto("groups").alias("group"), dealt("blocks").alias("block"))
    leads = asks.join(sizes, "target").select("rep", "n", "sig", "target", F.lit(True).alias("lead"), dealt("groups").alias("group"), upto("blocks").alias("block"))
    both = members.unionByName(leads)
    sets = _likely(sets, both.select(F.col("rep").alias("doc_id")))
    rows = both.join(sets.select(F.col("doc_id").alias("rep"), "members"), "rep")
    rows = rows.repartition("target", "group", "block").sortWithinPartitions("target", "group", "block", F.desc("lead"), "rep")
    with arrow_rows(asks.sparkSession, 500):
        return written(rows.mapInArrow(freed(run), "a long, b long").distinct(), "near-links")


RELABEL = 100  # new links are worth new labels on the way if there are more than one to so many labelled documents; this only saves comparisons


def linked_components(reps: DataFrame, docs: DataFrame, width: int, percent: int, roots: int, limit: int) -> DataFrame:
    """(id, component) of the representatives (rep, n, nodes, sig) of docs that have a link, as connected_components gives it. nodes: `roots` of each.

    Level by level: nodes nominate pairs, pairs are confirmed, and nodes that hold several components branch on.
    """
    spread = math.sqrt(COORDINATES * percent * (100 - percent)) / 100
    least = max(1, math.floor(COORDINATES * percent / 100 - 4 * spread))
    sigs = reps.select("rep", "n", "sig")
    now = _roots(reps, percent, roots, limit)
    found, links, level, sets, tried, met = None, None, 0, None, None, None
    while True:
        here = sigs if level == 0 else written(_likely(sigs, now.select("rep"), "rep"), "near-signatures")  # of the documents that this level still looks at
        told = written(_nominated(_dealt(_full(now, limit, level), limit, level).join(here, "rep"), percent, limit, least), "near-pairs")
        pairs = told.filter("not ask").select("a", "b", "hub")
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")  # a pair that failed stays out: its two sets won't change
        many = now.filter(_kind(limit, level) == MANY)
        if sets is None:  # members of later nodes come from the large ones here
            ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(many.select(F.col("rep").alias("doc_id")))
            with arrow_rows(docs.sparkSession, 500):
                sets = written(_sets(_likely(docs.select("doc_id", "text"), ids), width), "near-sets")
            new = confirmed_links(_likely(sets, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), pairs, percent)
        else:
            asks = told.filter("ask").select(F.col("a").alias("rep"), F.col("b").alias("target"))
            named = now.filter((_kind(limit, level) == CROWDED) & _by_name() & (F.col("label") != F.col("crowd")))
            asks = asks.unionByName(named.select("rep", F.col("crowd").alias("target"))).distinct()
            asks = written(asks if met is None else asks.join(met, ["rep", "target"], "left_anti"), "near-asks")
            new = confirmed_links(_likely(sets, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), pairs, percent)
            if not asks.isEmpty():
                new = new.unionByName(_component_links(asks, found, here, sigs, sets, percent, least))
                met = asks if met is None else met.unionByName(asks)
        tried = told.filter("not ask").select("a", "b") if tried is None else tried.unionByName(told.filter("not ask").select("a", "b"))
        if found is None:
            found = connected_components(new)
            labelled = found.count()
        else:
            links = new if links is None else links.unionByName(new)
            if RELABEL * new.count() > labelled:
                found, links = _joined(found, links), None
        if many.isEmpty():
            break
        # few outsiders meet all of their node next, others branch on
        open_ = _labelled(many, found)
        n = open_.count()
        if not n:
            break
        step, children = steps(percent)[min(level, len(CHILDREN_OF_LEVEL) - 1)]
        crowded = F.col("outside") <= CROWD
        below = written(_branch(open_.filter(~crowded).join(here, "rep"), step, children), "near-children", n * children)
        inner = _labelled(below, None)
        rows = written(inner.unionByName(open_.filter(crowded).select(now.columns)), "near-nodes")
        discard(now, open_, below, inner)
        now, level = rows, level + 1
    return found if links is None else _joined(found, links)


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """found (id, component) with the components that links (a, b) join made one."""
    return connected_components(links.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b"))))


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and the sorted shingle hashes, 48 bits each: the upper 32 of all, then the lower 16 of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                values, bounds = _distinct_shingles(data, offsets, width)
                upper, lower = (values >> np.uint64(32)).astype("<u4"), (values >> np.uint64(16)).astype("<u2")
                sets = [upper[a:b].tobytes() + lower[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo:hi], pa.array(sets, pa.binary())], ["doc_id", "members"])

    return docs.mapInArrow(freed(run), "doc_id long, members binary")


def _members(raw: pa.Buffer) -> np.ndarray:
    n = len(raw) // 6
    return (np.frombuffer(raw, "<u4", n).astype(np.uint64) << np.uint64(16)) | np.frombuffer(raw, "<u2", n, 4 * n)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return bool(common) and 100 * common >= percent * (len(x) + len(y) - common)


FILTER_BITS = 26  # of the filter that keeps rows nobody asks for from being shuffled or written: 8 MB whatever the table


def _likely(rows: DataFrame, ids: DataFrame, by: str = "doc_id") -> DataFrame:
    """The rows whose `by` is in ids (of the same column), and a few others: a bitmap of hashed ids, of fixed size, goes to all tasks and holds back most."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))
    bitmap = ids.select(place(by).alias("x")).groupBy(F.bitmap_bucket_number("x").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits"))
    x = rows.withColumn("x", place(by))
    x = x.withColumn("bucket", F.bitmap_bucket_number("x")).join(F.broadcast(bitmap), "bucket").withColumn("at", F.bitmap_bit_position("x"))
    byte = F.conv(F.hex(F.substr("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    x = x.filter(F.expr("1") == F.floor(byte / F.pow(F.lit(2), F.col("at") % 8)) % 2)
    return x.select(rows.columns)


PLACES = 8  # that the pairs of one document fall into; a pivot has those of its blocks, so their number doesn't grow with the table


def confirmed_links(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, each once; hub: a is what others are compared with, else b) whose full sets (doc_id, members) have 100 * intersection >= percent * union.

    A hub's set goes once to each of its places, and meets the sets of the others there: it isn't copied for each of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, None
        for batch in batches:
            good = []
            for h, p, rep, raw in zip(*(batch.column(c).to_pylist() for c in ("hub", "place", "rep")), batch.column("members"), strict=True):
                if rep == h:  # first of its place
                    at, hub = (h, p), _members(raw.as_buffer()).copy()
                elif at == (h, p) and _linked(hub, _members(raw.as_buffer()), percent):
                    good.append((min(h, rep), max(h, rep)))
            if good:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    hub, rep = (F.when(F.col("hub"), x).otherwise(y) for x, y in ((F.col("a"), F.col("b")), (F.col("b"), F.col("a"))))
    d = pairs.select(hub.alias("hub"), rep.alias("rep"))
    others = d.select("hub", F.pmod(F.xxhash64("rep", "hub"), F.lit(PLACES)).alias("place"), "rep")
    rows = others.unionByName(others.select("hub", "place", F.col("hub").alias("rep")).distinct()).join(sets.select(F.col("doc_id").alias("rep"), "members"), "rep")
    dealt = rows.select("hub", "place", "rep", "members").repartition("hub", "place").sortWithinPartitions("hub", "place", F.col("rep") != F.col("hub"), "rep")
    with arrow_rows(pairs.sparkSession, 100):
        return written(dealt.mapInArrow(freed(run), "a long, b long").distinct(), "near-links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, trees: int | None = None, limit: int = 16) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text); other columns are ignored.

    Words are runs outside 0x20 and 0x09-0x0D with A-Z in lower case. A document's set holds its distinct shingles of
    `width` words; with fewer words the whole sequence is its only member; without words (or with a null text) the set is
    empty and linked with nothing. Documents with 100 * intersection >= percent * union are linked; component_id is the
    smallest doc_id reachable, kept is doc_id = component_id. Repeated rows stay repeated and count as one document.
    Rows with a null doc_id are linked with nothing and kept. An empty table gives no rows. Shingles are told
    apart by hashes of 64 bits, in confirmed pairs of 48. trees: as many as needed_trees(percent) if not given.
    """
    trees = needed_trees(percent) if trees is None else trees
    sk = written(sketches(docs, width, trees), "near-sketches")
    classes = sk.filter("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min_by("nodes", "doc_id").alias("nodes"), F.min_by("sig", "doc_id").alias("sig"))
    reps = written(classes.withColumnRenamed("n_shingles", "n"), "near-classes")
    members = written(sk.select("doc_id", "n_shingles", "h1", "h2").join(reps.select("rep", "h1", "h2", F.col("n").alias("n_shingles")), ["h1", "h2", "n_shingles"], "left").select("doc_id", "n_shingles", "rep"), "near-members")
    found = linked_components(reps, docs, width, percent, trees * ROOTS_PER_TREE, limit)
    discard(sk, reps)
    out = members.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    out = out.withColumn("component_id", F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op2_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spread(table(spark, sf_dir, "documents")), width=3, percent=85)
