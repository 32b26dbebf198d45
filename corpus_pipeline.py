"""The training-data pipeline: documents through five stages, each written as Parquet and reread as the next one's input.

Toxic documents go, one document of each near-duplicate group stays, personal data become pseudonyms, sources are mixed to
their target weights (a document appears as often as the mix takes it), and every text becomes token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import bpe, mixing, neardup, pii, toxicity
from foliospark.session import table, written

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that score as toxic; the scorer learns from the labels of docs that aren't held out.

    Null and empty texts have no terms and stay, as do rows without a doc_id; repeated rows share their text's score. An empty table, and one without labels, gives all its rows.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rest = [c for c in docs.columns if c != "text"]
    whole = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in rest)).alias("__row"))  # a column of the caller's named score stays what it is; texts travel once
    return toxicity.toxicity_scores(whole, model).filter(F.col("score") < TOXIC_FROM).select(*("text" if c == "text" else F.col(f"__row.`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of 5 words, similarity of 0.8 or more.

    Rows with a null doc_id, and documents without words, are linked with nothing and stay; rows that repeat a kept doc_id all stay. An empty table gives none.
    """
    kept = neardup.near_duplicates(docs, width=5, percent=80).filter("kept").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    return named.unionByName(docs.filter("doc_id is null"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with pseudonyms for personal data; n_chars follows the text. Null and empty texts stay as they are. The key is pii.pseudonym_key's."""
    rest = [c for c in docs.columns if c != "text"]
    whole = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in rest)).alias("__row"))  # a column of the caller's named private stays what it is
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long").alias("n_chars")}
    return pii.pseudonymise(whole, key=pii.pseudonym_key(spark)).select(*(own.get(c, F.col(f"__row.`{c}`")) for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it, in the order of shards and of positions in them.

    Rows with a null doc_id are told apart by a hash of source and text; rows that repeat a doc_id are one document here, the one whose columns
    have the smallest hash, so reruns choose alike.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    keyed = docs.select(F.coalesce("doc_id", F.xxhash64(F.lit("no id"), "source", "text")).alias("__id"), F.col("source").alias("__source"), F.col("text").alias("__text"), whole)
    several = written(keyed.groupBy("__id").agg(F.count("*").alias("__n")).filter("__n > 1").select("__id"), "mix-repeated")
    if not several.isEmpty():
        first = keyed.join(several, "__id").withColumn("__hash", F.xxhash64(F.to_json("__row"))).groupBy("__id").agg(F.min_by(F.struct("__source", "__text", "__row"), F.struct("__hash", F.to_json("__row"))).alias("__first"))
        keyed = keyed.join(several, "__id", "left_anti").unionByName(first.select("__id", "__first.*"))
    sized = written(mixing.sized_documents(keyed.select(F.col("__id").alias("doc_id"), F.col("__source").alias("source"), F.col("__text").alias("text"))), "mix-sizes")
    draws = mixing.mix_sources(sized).select(F.col("doc_id").alias("__id"), F.explode("draws").alias("__draw")).select("__id", F.col("__draw.shard").alias("__shard"), F.col("__draw.position").alias("__position"))
    rows = keyed.select("__id", "__row").join(draws, "__id")
    return rows.repartitionByRange("__shard", "__position").sortWithinPartitions("__shard", "__position").select("__row.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, repeated ones too; a null text is empty."""
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", pseudonymise),
    ("mixing", mix),
    ("byte_bpe", tokenise),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
