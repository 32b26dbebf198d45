"""How the input tables stand for the engine's own: documents are cases, orders give them dates, and so on. Each also as SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators.postings import add_cases
from foliospark.session import exists, shared_dir, shuffles_removed, spread, table

ERAS = [("early", 1994), ("middle", 1996), ("late", 1999)]


def _stored(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder in which this application keeps what it has derived from one set of input tables."""
    return f"{shared_dir(spark)}/{name}-{hashlib.md5(sf_dir.encode()).hexdigest()}"


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cases as loaded: normalised once, by the first query that asks for them, and read by all others, which then read only the columns they need."""
    path = _stored(spark, sf_dir, "cases")
    if not exists(spark, f"{path}/_SUCCESS"):
        with shuffles_removed(spark):
            normalised_cases(spark, sf_dir).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def normalised_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_id, jurisdiction, court, name, cite, reporter, decision_date, year, era, raw_text and norm_text of each document."""
    docs = spread(table(spark, sf_dir, "documents"))
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.to_date("o_orderdate").alias("d"))
    out = docs.join(dates, "doc_id", "left").withColumn("norm_text", T.normalise(F.col("text")))
    words = F.regexp_extract("norm_text", r"^[^a-z0-9]*([a-z0-9]+(?:[^a-z0-9]+[a-z0-9]+){0,3})", 1)
    reporter = F.concat(F.lit("rep"), F.pmod("doc_id", F.lit(3)).cast("string"))
    return out.select(
        F.col("doc_id").alias("case_id"),
        F.col("source").alias("jurisdiction"),
        F.col("lang").alias("court"),
        F.regexp_replace(words, "[^a-z0-9]+", " ").alias("name"),
        F.concat_ws(" ", F.col("doc_id").cast("string"), reporter, F.expr("cast(n_chars as string)")).alias("cite"),
        reporter.alias("reporter"),
        F.date_format("d", "yyyy-MM-dd").alias("decision_date"),
        F.year("d").alias("year"),
        T.era_label(F.year("d"), ERAS).alias("era"),
        F.col("text").alias("raw_text"),
        "norm_text",
    )


def index(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the positional index over cases, written by the first query that asks for it and read by all others."""
    root = _stored(spark, sf_dir, "index")
    if not exists(spark, f"{root}/commits"):
        add_cases(cases(spark, sf_dir).select("case_id", "norm_text"), root)
    return root


def norm_sql(c: str) -> str:
    joined = f"regexp_replace(regexp_replace({c}, '([a-z])-\\s+([a-z])', '\\1\\2', 'g'), '([a-z])-\\s+([a-z])', '\\1\\2', 'g')"
    olds = "".join(T.CONFUSABLES) + T.JUNK
    news = "".join(T.CONFUSABLES.values()).replace("'", "''")
    plain = f"translate({joined}, '{olds}', '{news}')"
    for old, new in T.LIGATURES.items():
        plain = f"replace({plain}, '{old}', '{new}')"
    return f"trim(lower(regexp_replace({plain}, '\\s+', ' ', 'g')))"


def era_sql(y: str) -> str:
    return f"CASE WHEN {y} IS NULL THEN 'unknown' " + " ".join(f"WHEN {y} < {e} THEN '{n}'" for n, e in ERAS) + f" ELSE '{ERAS[-1][0]}' END"


CASES = f"""cases AS MATERIALIZED (
  SELECT doc_id AS case_id, source AS jurisdiction, lang AS court, array_to_string(list_slice(regexp_extract_all(norm_text, '[a-z0-9]+'), 1, 4), ' ') AS name,
    doc_id || ' rep' || (doc_id % 3) || ' ' || n_chars AS cite, 'rep' || (doc_id % 3) AS reporter,
    strftime(d, '%Y-%m-%d') AS decision_date, year(d) AS year, {era_sql("year(d)")} AS era, text AS raw_text, norm_text
  FROM (SELECT x.*, {norm_sql("text")} AS norm_text, CAST(o_orderdate AS DATE) AS d FROM documents x LEFT JOIN orders ON o_orderkey = doc_id)
)"""

#: token rows of a case, for the SQL of the full-text operators
TOKENS = "tok AS MATERIALIZED (SELECT case_id, regexp_extract_all(lower(strip_accents(norm_text)), '[\\p{L}\\p{N}]+') AS w FROM cases)"
