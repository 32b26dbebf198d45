"""Content-addressed store of token ids.

Ids of a document are cut where a rolling hash of the last ids says so, which makes equal passages equal chunks. The store is three
Parquet folders: `chunks` (digest -> ids, each distinct chunk once), `recipes` (in ascending doc_id order: the digests of a
document's chunks, its token count, its place in the stream, and the Merkle root of its chunks) and `manifest` (Merkle nodes over
the documents' roots, up to one root of everything). Reading checks every chunk against its digest, every document
against its root and length. Texts and ids don't travel when a store is read: checksums of chunks combine to those of documents.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm.textbytes import Texts, freed, mix, slices, windows
from foliospark.llm.units import UnitCache
from foliospark.session import shared_dir, spread, table

DIGEST = 16  # bytes of a chunk's BLAKE2b digest
LEAST, MEAN_BITS, MOST = 64, 8, 1024  # ids in a chunk: the least, 2**bits between cuts, the most
SPAN = 16  # ids that the rolling hash sees
FAN = 4096  # documents or nodes under a Merkle node, and rows of a step of the prefix sums
_ID_CODES = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, 1 << 16, dtype=np.uint64)


def merkle_root(leaves: list[bytes]) -> bytes:
    """SHA-256 tree over leaves; an odd node moves up alone. No leaves have the root of empty."""
    if not leaves:
        return hashlib.sha256(b"").digest()
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def cut_points(flat: np.ndarray, counts: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text's ids, counted from its first; the last is its length. The ids of all texts stand in flat."""
    h = windows(mix(_ID_CODES[flat & 0xFFFF] + flat.astype(np.uint64)), SPAN)
    marks = np.flatnonzero((h >> np.uint64(64 - MEAN_BITS)) == 0) + SPAN  # the id after each window that says so
    stops = np.cumsum(counts)
    starts = stops - counts
    lo, hi = np.searchsorted(marks, starts + SPAN), np.searchsorted(marks, stops, "right")
    out = []
    for first, n, a, b in zip(starts.tolist(), counts.tolist(), lo.tolist(), hi.tolist(), strict=True):
        cuts, at = [], 0
        if n > LEAST:
            for e in (marks[a:b] - first).tolist():
                while e - at > MOST:
                    at += MOST
                    cuts.append(at)
                if e - at >= LEAST:
                    cuts.append(e)
                    at = e
            while n - at > MOST:
                at += MOST
                cuts.append(at)
        if at < n or not cuts:
            cuts.append(n)
        out.append(cuts)
    return out


IS_MARK = np.zeros(256, bool)
IS_MARK[list(b".,!?;:%$&#*|")] = True  # never part of a word with letters
IS_UPPER = np.zeros(256, bool)
IS_UPPER[65:91] = True


def _is_letter(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the letters U+00C0 to U+024F."""
    out = np.zeros(len(data), bool)
    lower = data | 0x20
    out[(lower >= 97) & (lower <= 122)] = True
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))
    sign = (data[lead] == 0xC3) & ((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7))  # multiplication and division
    lead = lead[~sign]
    out[lead] = out[lead + 1] = True
    return out


class WordEncoder:
    """Ids of whole texts by a tokenizers file, for tokenizers that drop white space.

    Where tokens mark the ends of words and letters are always one word, a word of letters with marks after it is two pieces, and
    new pieces of letters are encoded many at a time in one text and told apart by those ends. Any other word is a piece encoded alone.
    """

    AT_ONCE = 4000

    def __init__(self, path: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        alone = lambda x: self._alone([x])[0].tolist()
        parts = ["Spark", ",", "cluster", ".", "Data"]
        self.split = bool(self.ends.any()) and alone("Spark, cluster. Data") == sum(map(alone, parts), []) and all(self.ends[alone(x)[-1]] for x in parts)
        self.folds = all(alone(chr(c)) == alone(chr(c + 32)) for c in range(65, 91))
        self.cache = UnitCache(self._encode, most)

    def _alone(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, units: list[bytes], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = np.zeros(len(units), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # (units, their ids in a row)
        at = np.flatnonzero(letters)
        single = [np.flatnonzero(~letters)]
        for k in range(0, len(at), self.AT_ONCE):
            some = at[k : k + self.AT_ONCE]
            text = b" ".join([units[i] for i in some.tolist()]).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                lens[some] = np.diff(ends, prepend=0)
                parts.append((some, ids))
            else:
                single.append(some)
        rest = np.concatenate(single)
        for k in range(0, len(rest), self.AT_ONCE):
            some = rest[k : k + self.AT_ONCE]
            found = self._alone([units[i].decode() for i in some.tolist()])
            lens[some] = [len(x) for x in found]
            parts.append((some, np.concatenate(found)))
        starts = np.cumsum(lens) - lens
        flat = np.zeros(int(lens.sum()), np.int32)
        for some, ids in parts:
            n = lens[some]
            flat[np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return flat, lens

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, how many each has)."""
        t = Texts(data, offsets)
        if not self.split or not len(t.start):
            return self.cache.ids(t, t.start, t.end, t.doc)
        last = np.maximum.accumulate(np.where(IS_MARK[data], -1, np.arange(len(data))))[t.end - 1] + 1
        core = np.maximum(last, t.start)  # where the marks at a word's end begin
        odd = np.r_[0, np.cumsum(~_is_letter(data))]
        plain = odd[core] == odd[t.start]
        core[~plain] = t.end[~plain]
        if self.folds:
            inside = np.zeros(len(data) + 1, np.int8)
            inside[t.start[plain]] += 1
            inside[core[plain]] -= 1
            t.data = data + (IS_UPPER[data] & (np.cumsum(inside[:-1], dtype=np.int8) > 0)).astype(np.uint8) * np.uint8(32)
        head, tail = core > t.start, t.end > core
        n = head.astype(np.int64) + tail
        place = np.cumsum(n) - n
        start, end, kind = np.empty(int(n.sum()), np.int64), np.empty(int(n.sum()), np.int64), np.zeros(int(n.sum()), bool)
        start[place[head]], end[place[head]], kind[place[head]] = t.start[head], core[head], plain[head]
        second = (place + head)[tail]
        start[second], end[second] = core[tail], t.end[tail]
        return self.cache.ids(t, start, end, np.repeat(t.doc, n), kind)


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode(docs: DataFrame, path: str, end_id: int, id_bytes: int = 2) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, id_bytes each), cuts, digests (joined) and root for every row of docs; a null text is empty.

    path: a tokenizers file that every executor has, of a tokenizer that drops white space: words are encoded one by one, each
    distinct one once. end_id ends every document. Words are told apart by 64-bit hashes. Other columns are ignored.
    """
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                flat, counts = encoder(data, offsets)
                flat = np.insert(flat, np.cumsum(counts), end_id)
                counts = counts + 1
                all_cuts = cut_points(flat, counts)
                everything = memoryview(flat.astype(kind).tobytes())
                rows: tuple[list, ...] = ([], [], [], [])
                for a, cuts in zip(((np.cumsum(counts) - counts) * id_bytes).tolist(), all_cuts, strict=True):
                    raw = everything[a : a + cuts[-1] * id_bytes]
                    digests = [hashlib.blake2b(raw[x * id_bytes : y * id_bytes], digest_size=DIGEST).digest() for x, y in zip([0, *cuts], cuts, strict=False)]
                    for out, value in zip(rows, (raw, cuts, b"".join(digests), merkle_root(digests)), strict=True):
                        out.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], pa.array(counts), pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.list_(pa.int32())), pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.binary())],
                    ["doc_id", "n_tokens", "ids", "cuts", "digests", "root"],
                )

    return docs.select("doc_id", "text").mapInArrow(freed(run), "doc_id long, n_tokens long, ids binary, cuts array<int>, digests binary, root binary")


def with_starts(rows: DataFrame, order: str, value: str, tie: str) -> DataFrame:
    """Adds `start`: the sum of `value` over all rows before, in ascending order of the whole number `order` (then `tie`).

    Sums over FAN consecutive numbers, over FAN such runs and so on; every window holds one run, so none grows with the table.
    """
    edges = rows.agg(F.max(F.abs(F.col(order)))).first()[0] or 0
    level = rows.withColumn("__0", F.floor(F.col(order) / FAN).cast("long"))
    before = lambda by, *o: Window.partitionBy(by).orderBy(*o).rowsBetween(Window.unboundedPreceding, -1)
    out = level.withColumn("start", F.coalesce(F.sum(value).over(before("__0", order, tie)), F.lit(0)))
    sums = level.groupBy(F.col("__0").alias("__k")).agg(F.sum(value).alias("__v"))
    span, key = FAN, "__0"
    while span <= edges * 2 + FAN:
        up = sums.withColumn("__up", F.floor(F.col("__k") / FAN).cast("long"))
        up = up.withColumn("__before", F.coalesce(F.sum("__v").over(before("__up", "__k")), F.lit(0)))
        out = out.join(up.select(F.col("__k").alias(key), "__before", "__up"), key).withColumn("start", F.col("start") + F.col("__before")).drop("__before", key).withColumnRenamed("__up", "__0")
        sums = up.groupBy(F.col("__up").alias("__k")).agg(F.sum("__v").alias("__v"))
        span *= FAN
    top = sums.select(F.col("__k").alias("__0"), F.coalesce(F.sum("__v").over(Window.orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return out.join(F.broadcast(top), "__0").withColumn("start", F.col("start") + F.col("__before")).drop("__0", "__before")  # two runs at most: below and from 0


def write_store(docs: DataFrame, folder: str, path: str, end_id: int, id_bytes: int = 2) -> None:
    """Writes chunks, recipes and manifest of docs (doc_id, text) into folder, which all executors reach. An empty table gives an empty store.

    Rows with a null doc_id are refused, as they have no place in the stream.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("doc_id", F.coalesce("doc_id", F.raise_error(F.lit("a document without doc_id has no place in the stream")).cast("long")))
    encode(keyed, path, end_id, id_bytes).write.option("compression", "zstd").parquet(f"{folder}/staged")
    staged = spark.read.parquet(f"{folder}/staged")
    place = F.transform("cuts", lambda c, i: F.struct(F.when(i > 0, F.col("cuts")[i - 1]).otherwise(0).alias("a"), c.alias("b"), i.alias("i")))
    piece = F.transform(place, lambda p: F.struct(F.substr("digests", p["i"] * DIGEST + 1, F.lit(DIGEST)).alias("digest"), F.substr("ids", p["a"] * id_bytes + 1, (p["b"] - p["a"]) * id_bytes).alias("ids")))
    chunks = staged.select(F.explode(piece).alias("c")).select("c.digest", "c.ids").groupBy("digest").agg(F.first("ids").alias("ids"))
    chunks.write.option("compression", "zstd").parquet(f"{folder}/chunks")
    recipes = with_starts(staged.select("doc_id", "n_tokens", "cuts", "digests", "root"), "doc_id", "n_tokens", "root")
    recipes.repartitionByRange("doc_id", "start").sortWithinPartitions("doc_id", "start").write.option("compression", "zstd").parquet(f"{folder}/recipes")
    write_manifest(spark, folder)


def manifest_nodes(recipes: DataFrame) -> DataFrame:
    """(level, node, n_docs, root): SHA-256 over the roots of up to FAN consecutive numbers of the level below, in order; level 0 is documents."""
    level = recipes.select(F.col("doc_id").alias("node"), F.lit(1).cast("long").alias("n_docs"), "root", "start")
    out, depth, edge = [], 0, recipes.agg(F.max(F.abs("doc_id"))).first()[0] or 0
    while depth == 0 or edge:
        depth, edge = depth + 1, edge // FAN
        roots = F.transform(F.array_sort(F.collect_list(F.struct("node", "start", "root"))), lambda x: F.hex(x["root"]))
        level = level.groupBy(F.floor(F.col("node") / FAN).cast("long").alias("node")).agg(F.sum("n_docs").alias("n_docs"), F.min("start").alias("start"), F.unhex(F.sha2(F.array_join(roots, ""), 256)).alias("root"))
        out.append(level.select(F.lit(depth).alias("level"), "node", "n_docs", "root"))
    nodes = out[0]
    for df in out[1:]:
        nodes = nodes.unionByName(df)
    return nodes


def write_manifest(spark: SparkSession, folder: str) -> None:
    manifest_nodes(spark.read.parquet(f"{folder}/recipes")).write.parquet(f"{folder}/manifest")


def verify_recipes(spark: SparkSession, folder: str) -> None:
    """Fails unless the recipes give the stored manifest, node by node, and each start is the sum of the lengths before it."""
    recipes = spark.read.parquet(f"{folder}/recipes").select("doc_id", "start", "n_tokens", "root")
    found = manifest_nodes(recipes).select("level", "node", F.struct("n_docs", "root").alias("found"))
    stored = spark.read.parquet(f"{folder}/manifest").select("level", "node", F.struct("n_docs", "root").alias("stored"))
    wrong = found.join(stored, ["level", "node"], "full").filter(~F.col("found").eqNullSafe(F.col("stored")))
    first = wrong.select("level", "node").first()
    if first:
        raise ValueError(f"the recipes aren't what the manifest says, at level {first['level']}, node {first['node']}")
    rows = recipes.withColumn("tie", F.struct("root", "start")).withColumnRenamed("start", "was")
    first = with_starts(rows, "doc_id", "n_tokens", "tie").filter("start is distinct from was").select("doc_id").first()
    if first:
        raise ValueError(f"the start of document {first['doc_id']} isn't the sum of the lengths before it")


def _zero_tables() -> np.ndarray:
    """For each k, the effect on a CRC-32 of 2**k zero bytes, by the four bytes of its value."""
    basis = [np.uint32(1 << i) for i in range(32)]
    one = [np.uint32(zlib.crc32(b"\0", int(b) ^ 0xFFFFFFFF) ^ zlib.crc32(b"\0", 0xFFFFFFFF)) for b in basis]
    columns, out = np.array(one, np.uint32), []
    for _ in range(40):
        tables = np.zeros((4, 256), np.uint32)
        for i in range(32):
            byte, bit = divmod(i, 8)
            tables[byte] ^= np.where(np.arange(256) >> bit & 1, columns[i], np.uint32(0)).astype(np.uint32)
        out.append(tables)
        columns = _apply(tables, columns)
    return np.array(out)


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 0xFF] ^ tables[1][x >> 8 & 0xFF] ^ tables[2][x >> 16 & 0xFF] ^ tables[3][x >> 24]


def shifted_crc(crc: np.ndarray, tail: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """What CRC-32 values of parts add to that of the whole, when `tail` bytes follow each part."""
    out = crc.astype(np.uint32)
    for k in range(int(tail.max(initial=0)).bit_length()):
        at = np.flatnonzero(tail >> k & 1)
        out[at] = _apply(tables[k], out[at])
    return out


def read_store(spark: SparkSession, folder: str, id_bytes: int = 2) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as unsigned 32-bit little-endian numbers) of each document, verified.

    Fails if a chunk is missing, isn't what its digest says, or a document's root or length differs; and at once if the recipes
    differ from the manifest or their starts aren't running sums.
    """
    verify_recipes(spark, folder)
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, crcs, counts = batch.column("digest"), [], []
            for digest, ids in zip(digests, batch.column("ids"), strict=True):
                raw = ids.as_buffer()
                if hashlib.blake2b(raw, digest_size=DIGEST).digest() != digest.as_py():
                    raise ValueError(f"chunk {digest.as_py().hex()} isn't what its digest says")
                crcs.append(zlib.crc32(np.frombuffer(raw, kind).astype("<u4").tobytes()))
                counts.append(len(raw) // id_bytes)
            yield pa.RecordBatch.from_arrays([digests, pa.array(crcs, pa.int64()), pa.array(counts, pa.int64())], ["digest", "crc", "n"])

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digests, root in zip(batch.column("digests"), batch.column("root"), strict=True):
                d = digests.as_py()
                if merkle_root([d[i : i + DIGEST] for i in range(0, len(d), DIGEST)]) != root.as_py():
                    raise ValueError("a recipe isn't what its root says")
            yield batch.select(["doc_id", "start", "n_tokens", "cuts", "digests"])

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _zero_tables()
        for batch in batches:
            crc, tail = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("crc", "tail"))
            part = shifted_crc(crc, tail, tables).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("doc_id", "start", "n_tokens", "n")), pa.array(part)], ["doc_id", "start", "n_tokens", "n", "part"])

    chunks = spark.read.parquet(f"{folder}/chunks").mapInArrow(checked, "digest binary, crc long, n long")
    recipes = spark.read.parquet(f"{folder}/recipes").select("doc_id", "start", "n_tokens", "cuts", "digests", "root")
    recipes = recipes.mapInArrow(rooted, "doc_id long, start long, n_tokens long, cuts array<int>, digests binary")
    listed = F.transform("cuts", lambda c, i: F.struct(F.substr("digests", i * DIGEST + 1, F.lit(DIGEST)).alias("digest"), ((F.col("n_tokens") - c) * 4).alias("tail")))
    pieces = recipes.select("doc_id", "start", "n_tokens", F.explode(listed).alias("p")).select("doc_id", "start", "n_tokens", "p.digest", "p.tail")
    joined = pieces.join(chunks, "digest", "left").select("doc_id", "start", "n_tokens", "tail", F.coalesce("crc", F.lit(0)).alias("crc"), F.coalesce("n", F.lit(0)).alias("n"))
    parts = joined.mapInArrow(shifted, "doc_id long, start long, n_tokens long, n long, part long")
    docs = parts.groupBy("doc_id", "start", "n_tokens").agg(F.bit_xor("part").alias("ids_crc32"), F.sum("n").alias("__n"))
    whole = F.when(F.col("__n") == F.col("n_tokens"), F.col("ids_crc32")).otherwise(F.raise_error(F.lit("a document's chunks don't add up to its length")).cast("long"))
    return docs.select("doc_id", "start", "n_tokens", whole.alias("ids_crc32"))


def read_documents(spark: SparkSession, folder: str, id_bytes: int = 2) -> DataFrame:
    """doc_id, start and ids (little-endian bytes) of each document, put together from its chunks."""
    recipes = spark.read.parquet(f"{folder}/recipes")
    listed = F.transform("cuts", lambda c, i: F.struct(i.alias("i"), F.substr("digests", i * DIGEST + 1, F.lit(DIGEST)).alias("digest")))
    pieces = recipes.select("doc_id", "start", F.explode(listed).alias("p")).select("doc_id", "start", "p.i", "p.digest")
    joined = pieces.join(spark.read.parquet(f"{folder}/chunks"), "digest").groupBy("doc_id", "start")
    ordered = F.array_sort(F.collect_list(F.struct("i", "ids")))
    return joined.agg(F.unhex(F.array_join(F.transform(ordered, lambda x: F.hex(x["ids"])), "")).alias("ids"))


def op4_token_store(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_dir(spark)}/token-store-{uuid.uuid4().hex}"
    write_store(spread(table(spark, sf_dir, "documents")), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_store(spark, folder)
