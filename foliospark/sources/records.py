"""JSON records and batch files in, tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.session import written


def record_arrays(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(records of every JSON file under path, files that can't be read). A file holds an array of records, or one record."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read = StructType([*schema.fields, *StructType.fromDDL("_bad string").fields])
    d = spark.read.schema(read).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", True).json(path)
    d = written(d.withColumn("file", F.col("_metadata.file_path")), "records")
    return d.filter("_bad is null").drop("_bad"), d.filter("_bad is not null").select("file").distinct()


#: The fields of a batch file that are read.
BATCH = (
    "batch_id string, era_partition string, jurisdiction string, ranker_id string, cases array<struct<case_id:long,rank_score:double,"
    "signals:array<struct<selector_id:string,selector_version:int,matched_text:string,chunk_id:long,cosine:double,run_id:string>>>>"
)


def pool_batches(spark: SparkSession, path: str) -> DataFrame:
    """The batches of the pool under path: files batch-*.json; retry files and others don't belong to it."""
    d = spark.read.schema(BATCH).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "batch-*.json").json(path)
    return d.filter(~F.col("batch_id").contains("retry"))


def batch_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(batches with `file` and `kind`, broken files with their `file`) of all JSON files under path, however many and small: Spark packs them into tasks by size.

    A file is told by the part of its path that names a batch: batch-*.json is of the pool, one with "retry" in its name a retry, any other kind isn't read. A
    file that isn't JSON, or has no batch_id or cases, is broken and stops nothing.
    """
    named = r"(batch-[^/]*\.json)"
    read = spark.read.schema(BATCH + ", _bad string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", True)
    d = read.json(path).withColumn("file", F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), named, 1)).filter("file <> ''")
    d = written(d.withColumn("kind", F.when(F.contains("file", F.lit("retry")), "retry").otherwise("pool")), "batch-files")
    bad = F.col("_bad").isNotNull() | F.col("batch_id").isNull() | F.col("cases").isNull()
    return d.filter(~bad).drop("_bad"), d.filter(bad).select("file").distinct()


def write_csv(rows: DataFrame, columns: list[str], path: str) -> None:
    """The columns in their order, with a header; nulls are empty."""
    rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns)).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_jsonl(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """One JSON object a line, with its nulls, in folders of the values of `by` where given."""
    out = rows.write.mode("overwrite").option("ignoreNullFields", False)
    (out.partitionBy(*by) if by else out).json(path)
