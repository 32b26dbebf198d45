"""Chunks, vectors and the citation graph."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_windows(tokens: Column, size: int, overlap: int) -> Column:
    """Array of (seq, first, last) of overlapping token windows; the first window that reaches the end is the last. No tokens, no windows."""
    n, step = F.size(tokens), size - overlap
    count = F.when(n > 0, F.greatest(F.ceil((n - size) / step).cast("int"), F.lit(0)) + 1).otherwise(0)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("seq"), (i * step).alias("first"), F.least(i * step + size, n).alias("last")))


def chunks(cases: DataFrame, size: int, overlap: int) -> DataFrame:
    """case_id, seq and text of every window of white-space tokens."""
    d = cases.select("case_id", F.filter(F.split("norm_text", " "), lambda x: x != "").alias("t"))
    d = d.select("case_id", "t", F.explode(chunk_windows(F.col("t"), size, overlap)).alias("w"))
    return d.select("case_id", "w.seq", F.array_join(F.slice("t", F.col("w.first") + 1, F.col("w.last") - F.col("w.first")), " ").alias("text"))


def embedding_input(template: list[str], text: Column) -> Column:
    """The values of the template's columns and the text, joined by ' | '; a null is ''."""
    return F.array_join(F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in template), F.coalesce(text, F.lit(""))), " | ")


def quantised(v: Column) -> Column:
    """(scale, q): the vector at length 1, in whole numbers of -127 to 127 of scale max|v| / 127; a zero vector stays zero."""
    let = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))  # noqa: E731  value is computed once, not once an element
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = let(norm, lambda n: F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(0.0)))

    def whole(u: Column) -> Column:
        return let(F.array_max(F.transform(u, F.abs)) / 127, lambda s: F.struct(s.alias("scale"), F.transform(u, lambda x: F.when(s > 0, F.bround(x / s)).otherwise(0).cast("int")).alias("q")))

    return let(unit, whole)


def packed_codes(q: Column) -> Column:
    """Whole numbers of -128 to 127 as one byte each: how quantised vectors are stored."""
    return F.unhex(F.array_join(F.transform(q, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(255))), 2, "0")), ""))


def _byte_rows(column: pa.Array, dim: int) -> np.ndarray:
    """A binary column of dim bytes a row as a matrix, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.int8)[offsets[0] : offsets[-1]].reshape(len(column), dim)


def scored_codes(vectors: DataFrame, queries: dict[str, list[float]], whole: bool = False) -> DataFrame:
    """vectors (id columns, `code`: one byte a number, `scale`) with a column sim_<name> for each query: (code . query) * scale, all queries in one pass.

    Codes go from Arrow's buffer into matrices, in blocks of rows, and never become Python lists. whole: queries are quantised, too, and products are
    whole numbers of 32 bits, times both scales. A null code, or one of another length, gives null.
    """
    names = sorted(queries)
    q = np.array([queries[k] for k in names], float)
    dim = q.shape[1]
    q_scale = np.ones(len(names))
    if whole:
        q_scale = np.where(np.abs(q).max(axis=1) > 0, np.abs(q).max(axis=1) / 127, 1.0)
        q = np.rint(q / q_scale[:, None]).astype(np.int32)  # dim * 127 * 127 fits 32 bits up to 133,000 numbers

    def run(batches):
        for batch in batches:
            code, scale = batch.column("code"), batch.column("scale").to_numpy(zero_copy_only=False)
            good = np.flatnonzero(pc.fill_null(pc.equal(pc.binary_length(code), dim), False).to_numpy(zero_copy_only=False))
            sims = np.full((len(code), len(names)), np.nan)
            for k in range(0, len(good), 4096):
                at = good[k : k + 4096]
                m = _byte_rows(code.take(pa.array(at)), dim)
                products = m.astype(np.int32) @ q.T if whole else m.astype(float) @ q.T
                sims[at] = products * scale[at, None] * q_scale
            kept = [c for c in batch.schema.names if c not in ("code", "scale")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(sims[:, i], mask=np.isnan(sims[:, i])) for i in range(len(names)))], [*kept, *(f"sim_{k}" for k in names)])

    keep = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in vectors.schema.fields if f.name not in ("code", "scale"))
    return vectors.mapInArrow(run, keep + ", ".join(f"sim_{k} double" for k in names))


def scored(vectors: DataFrame, queries: dict[str, list[float]]) -> DataFrame:
    """vectors (id columns and `v` array<double>) with a column sim_<name> for each query: all queries in one pass of matrix products over Arrow batches."""
    names = sorted(queries)
    q = np.array([queries[k] for k in names], float).T

    def run(batches):
        for pdf in batches:
            sims = (np.array(pdf["v"].tolist(), float).reshape(len(pdf), len(q)) @ q) if len(pdf) else np.zeros((0, len(names)))
            yield pdf.drop(columns="v").assign(**{f"sim_{k}": sims[:, i] for i, k in enumerate(names)})

    keep = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields if f.name != "v")
    return vectors.mapInPandas(run, keep + "".join(f", sim_{k} double" for k in names))


def top_cases(sims: DataFrame, k: int, min_cosine: float, partition: list[str], seeds: DataFrame | None = None) -> DataFrame:
    """case_id, rank and sim of at most k cases of each partition: by -sim and chunk_id, the first 3k chunks, then those of min_cosine, the first chunk of a case, no seeds.

    The rank limit is applied inside tasks before the shuffle (Spark's rank-limit windows).
    """
    part = Window.partitionBy(*partition)
    d = sims.withColumn("place", F.row_number().over(part.orderBy(F.desc("sim"), "chunk_id"))).filter(F.col("place") <= 3 * k).filter(F.col("sim") >= min_cosine)
    d = d.groupBy(*partition, "case_id").agg(F.min(F.struct("place", "sim")).alias("b"))
    d = d.join(seeds, "case_id", "left_anti") if seeds is not None else d
    d = d.select(*partition, "case_id", "b.place", "b.sim").withColumn("rank", F.row_number().over(part.orderBy("place")))
    return d.filter(F.col("rank") <= k).drop("place")


def mean_query(vectors: DataFrame) -> DataFrame:
    """One row: the mean of the vectors `v` at length 1, by position."""
    means = vectors.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"))
    m = means.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("m"), F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("n"))
    return m.select(F.transform("m", lambda x: x / F.col("n")).alias("q"))


def runs_of_cells(cells: DataFrame, chunk_rows: DataFrame) -> DataFrame:
    """The embedding runs that each cell holds, cells without any included."""
    runs = chunk_rows.groupBy("cell").agg(F.array_sort(F.collect_set("run")).alias("runs"))
    return cells.join(runs, "cell", "left").withColumn("runs", F.coalesce("runs", F.array().cast("array<string>")))


def one_run(chunk_rows: DataFrame) -> DataFrame:
    """chunk_rows; more than one embedding run among them fails the job."""
    n = chunk_rows.agg(F.count_distinct("run").alias("__n"))
    bad = F.raise_error(F.lit("more than one embedding run in scope")).cast("string")
    return chunk_rows.join(F.broadcast(n), F.lit(True)).withColumn("run", F.when(F.col("__n") <= 1, F.col("run")).otherwise(bad)).drop("__n")


def to_embed(cases: DataFrame, chunk_rows: DataFrame, run: str, cells: list[tuple[str, str]] | None = None, quota: int | None = None, limit: int | None = None) -> DataFrame:
    """Canonical cases with a text and without chunks of this run, by lowest id.

    cells: (era, jurisdiction) pairs that are embedded at all; quota: cases of one cell at most; limit: cases in all.
    """
    done = chunk_rows.filter(F.col("run") == run).select("case_id").distinct()
    d = cases.filter("is_duplicate_of is null and norm_text <> ''")
    if cells is not None:
        d = d.filter(F.struct("era", "jurisdiction").isin([F.struct(F.lit(e), F.lit(j)) for e, j in cells]) if cells else F.lit(False))
    d = d.join(done, "case_id", "left_anti")
    if quota is not None:
        place = F.row_number().over(Window.partitionBy("era", "jurisdiction").orderBy("case_id"))  # tasks keep a cell's first rows before the shuffle
        d = d.withColumn("__place", place).filter(F.col("__place") <= quota).drop("__place")
    return d.orderBy("case_id").limit(limit) if limit else d


def consistency(a: DataFrame, b: DataFrame, bar: float) -> DataFrame:
    """n, mean, p5, least cosine of two vector sets by id, and whether p5 reaches the bar."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)
    d = a.select("id", F.col("v").alias("x")).join(b.select("id", F.col("v").alias("y")), "id")
    cos = dot("x", "y") / F.sqrt(dot("x", "x") * dot("y", "y"))
    return d.select(cos.alias("c")).agg(F.count("*").alias("n"), F.avg("c").alias("mean"), F.percentile("c", 0.05).alias("p5"), F.min("c").alias("least")).withColumn("ok", F.col("p5") >= bar)


def best_chunk_text(cases: DataFrame, chunk_rows: DataFrame, signals: DataFrame, length: int = 2000) -> DataFrame:
    """case_id and text for pair scoring: the chunk of the highest cosine (lowest id), else the first chunk, else the text's beginning."""
    best = signals.filter("chunk_id is not null").groupBy("case_id").agg(F.min_by("chunk_id", F.struct(-F.col("cosine"), "chunk_id")).alias("chunk_id"))
    best = best.join(chunk_rows.select("chunk_id", F.col("text").alias("best")), "chunk_id").select("case_id", "best")
    first = chunk_rows.groupBy("case_id").agg(F.min_by("text", "seq").alias("first"))
    d = cases.join(best, "case_id", "left").join(first, "case_id", "left")
    return d.select("case_id", F.coalesce("best", "first", F.substring("norm_text", 1, length)).alias("text"))


def neighbours(edge_rows: DataFrame, seeds: DataFrame, direction: str) -> DataFrame:
    """case_id, matched_text: what cites the seeds, what they cite, or both; seeds left out, one row a case, citing first, the first citation by text."""
    s = seeds.select("case_id").distinct()
    citing = edge_rows.join(s.withColumnRenamed("case_id", "cited"), "cited", "left_semi").groupBy(F.col("citing").alias("case_id")).agg(F.concat(F.lit("cites "), F.min("cite")).alias("t"))
    cited = edge_rows.join(s.withColumnRenamed("case_id", "citing"), "citing", "left_semi").groupBy(F.col("cited").alias("case_id")).agg(F.concat(F.lit("cited by "), F.min("cite")).alias("t"))
    parts = {"citing": [(0, citing)], "cited": [(1, cited)], "both": [(0, citing), (1, cited)]}[direction]
    rows = [df.withColumn("p", F.lit(p)) for p, df in parts]
    both = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
    out = both.groupBy("case_id").agg(F.min(F.struct("p", "t")).alias("b")).join(s, "case_id", "left_anti")
    return out.select("case_id", F.col("b.t").alias("matched_text"))




def embedding_cost(cases: DataFrame, size: int, overlap: int, sample: int, seed: str, price: float) -> DataFrame:
    """One row: n_cases, sampled, tokens (of all chunks of a keyed sample, scaled up) and cost at a price a million tokens."""
    n = cases.agg(F.count("*").alias("n_cases"))
    some = cases.orderBy(F.md5(F.concat_ws("|", F.lit(seed), "case_id")), "case_id").limit(sample)
    words = chunks(some, size, overlap).select("case_id", F.size(F.filter(F.split("text", " "), lambda x: x != "")).alias("k"))
    counted = some.select(F.count("*").over(Window.partitionBy()).alias("sampled")).limit(1).crossJoin(words.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("k")))
    tokens = F.round(F.col("k") * F.col("n_cases") / F.col("sampled")).cast("long")
    return n.crossJoin(counted).select("n_cases", "sampled", tokens.alias("tokens"), (tokens * price / 1_000_000).alias("cost"))
