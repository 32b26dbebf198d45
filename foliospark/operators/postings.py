"""A positional index of cases' tokens, written once and read by term.

A segment is a range-sorted table of (token, case_id, pos) in `buckets` ranges, each a folder of its own, beside the first and last
token of every range, the counts of distinct tokens, and the case ids. A query reads the ranges that can hold
its tokens, of which Parquet's own minima leave out more. New cases become new segments, deletions a table of ids that holds for
the segments before it, and a merge makes one segment of all. sources.versions says which parts count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.fold import folded
from foliospark.functions.stem import stemmed
from foliospark.functions.text import tokens
from foliospark.sources.versions import commit, live_parts, next_number

BUCKETS = 16
_ROW = "token string, case_id long, pos int"


def token_rows(cases: DataFrame) -> DataFrame:
    """(token, case_id, pos) of every token of norm_text without accents, positions from 0."""
    return cases.select("case_id", F.posexplode(tokens(folded(F.col("norm_text")))).alias("pos", "token")).select("token", "case_id", "pos")


def _write_segment(rows: DataFrame, ids: DataFrame, root: str, number: int, buckets: int) -> str:
    """Writes one segment of (token, case_id, pos): one shuffle, and a token with very many rows fills several ranges."""
    spark, part = rows.sparkSession, f"segment-{number:08d}"
    path = f"{root}/{part}"
    cut = rows.repartitionByRange(buckets, "token", "case_id", "pos").withColumn("bucket", F.spark_partition_id())
    cut.sortWithinPartitions("bucket", "token", "case_id", "pos").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    ids.write.mode("overwrite").parquet(f"{path}/cases")
    words = spark.read.schema(_ROW + ", bucket int").parquet(f"{path}/rows").groupBy("bucket", "token").agg(F.count("*").alias("n"))
    words.write.mode("overwrite").parquet(f"{path}/counts")
    words = spark.read.parquet(f"{path}/counts")
    words.groupBy("bucket").agg(F.min("token").alias("first"), F.max("token").alias("last"), F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")
    return part


def _parts(spark: SparkSession, root: str) -> list[tuple[int, str, bool]]:
    """(number, part, whether it is a segment) of the live parts, oldest first."""
    return sorted((int(p.rpartition("-")[2]), p, p.startswith("segment")) for p in live_parts(spark, root)[1])


def _gone(spark: SparkSession, root: str, parts: list[tuple[int, str, bool]]) -> DataFrame | None:
    """(case_id, upto): ids whose rows count no more in segments with a lower number."""
    found = [spark.read.parquet(f"{root}/{p}").withColumn("upto", F.lit(n)) for n, p, segment in parts if not segment]
    return reduce(DataFrame.unionByName, found).groupBy("case_id").agg(F.max("upto").alias("upto")) if found else None


def _standing(rows: DataFrame, gone: DataFrame | None) -> DataFrame:
    """rows (with case_id, segment) without those deleted after their segment."""
    if gone is None:
        return rows
    dead = gone.withColumnRenamed("case_id", "gone")
    return rows.join(dead, (rows["case_id"] == dead["gone"]) & (rows["segment"] < dead["upto"]), "left_anti")


def indexed_cases(spark: SparkSession, root: str) -> DataFrame:
    """case_id of all cases in the index."""
    parts = _parts(spark, root)
    found = [spark.read.parquet(f"{root}/{p}/cases").select("case_id", F.lit(n).alias("segment")) for n, p, segment in parts if segment]
    if not found:
        return spark.createDataFrame([], "case_id long")
    return _standing(reduce(DataFrame.unionByName, found), _gone(spark, root, parts)).select("case_id")


def add_cases(cases: DataFrame, root: str, buckets: int = BUCKETS) -> int:
    """Indexes the cases (case_id, norm_text) that the index doesn't hold, as a new segment; gives the version. Repeated ids in one call are the caller's to avoid."""
    spark = cases.sparkSession
    number = next_number(spark, root)
    _, parts = live_parts(spark, root)
    fresh = cases.join(indexed_cases(spark, root), "case_id", "left_anti") if parts else cases
    part = _write_segment(token_rows(fresh), fresh.select("case_id"), root, number, buckets)
    return commit(spark, root, [*parts, part])


def delete_cases(ids: DataFrame, root: str) -> int:
    """Takes the cases out of all segments written so far; they can be added again."""
    spark = ids.sparkSession
    part = f"gone-{next_number(spark, root):08d}"
    ids.select("case_id").distinct().write.mode("overwrite").parquet(f"{root}/{part}")
    return commit(spark, root, [*live_parts(spark, root)[1], part])


def merge_segments(spark: SparkSession, root: str, buckets: int = BUCKETS) -> int:
    """Writes what all segments and deletions come to as one segment; readers see the old parts until it is committed."""
    number = next_number(spark, root)
    part = _write_segment(all_postings(spark, root), indexed_cases(spark, root), root, number, buckets)
    return commit(spark, root, [part])


def all_postings(spark: SparkSession, root: str) -> DataFrame:
    """(token, case_id, pos) of the whole index."""
    return _read(spark, root, None)


Term = tuple[str, bool]  # a token, and whether longer tokens that begin with it count, too


def is_term(token: Column, term: Term) -> Column:
    return F.startswith(token, F.lit(term[0])) if term[1] else token == term[0]


def _read(spark: SparkSession, root: str, terms: list[Term] | None) -> DataFrame:
    parts, found = _parts(spark, root), []
    for n, part, segment in parts:
        if not segment:
            continue
        rows = spark.read.schema(_ROW + ", bucket int").parquet(f"{root}/{part}/rows")
        if terms is not None:
            ranges = spark.read.schema("bucket int, first string, last string, n long").parquet(f"{root}/{part}/ranges")
            # 'first' may begin with the term itself, when a range starts among its longer tokens
            near = [(F.col("last") >= t) & ((F.col("first") <= t) | (F.startswith("first", F.lit(t)) if more else F.lit(False))) for t, more in terms]
            buckets = [r["bucket"] for r in ranges.filter(reduce(Column.__or__, near)).select("bucket").collect()]  # at most as many as there are ranges
            exact = sorted({t for t, more in terms if not more})
            tests = ([F.col("token").isin(exact)] if exact else []) + [is_term(F.col("token"), t) for t in terms if t[1]]
            rows = rows.filter(F.col("bucket").isin(buckets)).filter(reduce(Column.__or__, tests))
        found.append(rows.select("token", "case_id", "pos", F.lit(n).alias("segment")))
    if not found:
        return spark.createDataFrame([], _ROW)
    return _standing(reduce(DataFrame.unionByName, found), _gone(spark, root, parts)).select("token", "case_id", "pos")


def term_postings(spark: SparkSession, root: str, terms: list[Term]) -> DataFrame:
    """(token, case_id, pos) of the tokens that are any of the terms: only ranges that can hold one are read."""
    return _read(spark, root, terms)


def words_of_stem(spark: SparkSession, root: str, stem: str) -> list[str]:
    """The indexed words of one stem. The stemmer changes the last three letters of a stem at most, so only words with its beginning are stemmed; it takes endings of a fixed list away, so there are some hundreds of words at most, whatever the corpus."""
    near = word_counts(spark, root).filter(F.startswith("token", F.lit(stem[: max(1, len(stem) - 3)])))
    return sorted(r["token"] for r in near.filter(stemmed(F.col("token")) == stem).select("token").collect())


def word_counts(spark: SparkSession, root: str) -> DataFrame:
    """token and n of the whole index, from its segments' counts; deletions since a merge are not taken off."""
    found = [spark.read.parquet(f"{root}/{p}/counts").select("token", "n") for _, p, segment in _parts(spark, root) if segment]
    rows = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "token string, n long")
    return rows.groupBy("token").agg(F.sum("n").alias("n"))
