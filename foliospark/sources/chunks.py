"""Stored chunk rows that are replaced case by case.

Embedding a case again replaces all rows it had, whatever run they came from. New rows are a new part; a part says which cases it replaces, and of
a case only the newest part counts. sources.versions makes a part count by one commit, so a writer that dies before it leaves the old rows readable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources.versions import commit, live_parts, next_number


def replace_cases(rows: DataFrame, root: str, cases: DataFrame | None = None) -> int:
    """Puts rows (case_id, ...) in place of all that their cases have; gives the version. cases: the cases replaced (case_id), where some have no rows any more."""
    spark = rows.sparkSession
    part = f"part-{next_number(spark, root):08d}"
    path = f"{root}/{part}"
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    (spark.read.parquet(f"{path}/rows") if cases is None else cases).select("case_id").distinct().write.mode("overwrite").parquet(f"{path}/cases")
    return commit(spark, root, [*live_parts(spark, root)[1], part])


def current_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows that count. A table of one part is read as it is; else rows meet the newest part of their case, by ids alone."""
    parts = live_parts(spark, root)[1]
    if not parts:
        raise ValueError(f"no chunks have been committed to {root}")
    read = lambda p, what: spark.read.parquet(f"{root}/{p}/{what}")
    if len(parts) == 1:
        return read(parts[0], "rows")
    newest = reduce(DataFrame.unionByName, (read(p, "cases").withColumn("__part", F.lit(i)) for i, p in enumerate(parts))).groupBy("case_id").agg(F.max("__part").alias("__part"))
    rows = reduce(DataFrame.unionByName, (read(p, "rows").withColumn("__part", F.lit(i)) for i, p in enumerate(parts)))
    return rows.join(newest, ["case_id", "__part"], "left_semi").drop("__part")


def merge_parts(spark: SparkSession, root: str) -> int:
    """Writes what counts as one part."""
    rows, part = current_rows(spark, root), f"part-{next_number(spark, root):08d}"
    rows.write.mode("overwrite").parquet(f"{root}/{part}/rows")
    spark.read.parquet(f"{root}/{part}/rows").select("case_id").distinct().write.mode("overwrite").parquet(f"{root}/{part}/cases")
    return commit(spark, root, [part])
