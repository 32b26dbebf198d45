"""Folders of immutable parts and the commits that say which of them count.

A writer first writes its parts under new names, then commits: one file in a new folder of `commits` lists all live parts. Readers
take the newest commit, so a job that dies between writing and committing leaves the old rows readable and nothing half replaced.
There is one writer at a time; parts that no commit lists can be removed at any time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from foliospark.session import exists, remove

SCHEMA = "part string, version long"


def live_parts(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """(version, parts in the order of their commits); version 0 and none where nothing was committed. The list holds one name a part, not a row."""
    if not exists(spark, f"{root}/commits"):
        return 0, []
    rows = spark.read.schema(SCHEMA).parquet(f"{root}/commits")
    newest = rows.agg(F.max("version")).first()[0]
    if newest is None:
        return 0, []
    found = [r["part"] for r in rows.filter(F.col("version") == newest).collect()]
    return newest, sorted(p for p in found if p)


def commit(spark: SparkSession, root: str, parts: list[str]) -> int:
    """Makes these parts, and no others, the live ones. Gives the new version."""
    version = live_parts(spark, root)[0] + 1
    rows = spark.createDataFrame([(p,) for p in sorted(parts)] or [("",)], "part string")  # an empty list is a commit, too
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/version={version}")  # a folder that a failed commit left holds no row
    return version


def next_number(spark: SparkSession, root: str) -> int:
    """A number above those of all parts that any commit lists; parts of failed writers may be written over."""
    if not exists(spark, f"{root}/commits"):
        return 1
    found = spark.read.schema(SCHEMA).parquet(f"{root}/commits").filter("part <> ''").agg(F.max(F.regexp_extract("part", r"(\d+)$", 1).cast("long"))).first()[0]
    return (found or 0) + 1


def vacuum(spark: SparkSession, root: str, written: list[str]) -> None:
    """Removes those of the parts written that the newest commit doesn't list."""
    live = set(live_parts(spark, root)[1])
    for part in written:
        if part not in live:
            remove(spark, f"{root}/{part}")
