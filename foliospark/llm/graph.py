"""Connected components of an edge table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.session import discard, written


def _is_forest(edges: DataFrame) -> bool:
    """True if no vertex has two parents or is both child and parent."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("parent")), F.struct(F.col("v").alias("x"), F.lit(None).cast("long").alias("parent")))).alias("e")).select("e.*")
    seen = ends.groupBy("x").agg(F.min("parent").alias("least"), F.max("parent").alias("most"), F.max(F.col("parent").isNull()).alias("of_others"))
    return seen.filter("least is not null and (least <> most or of_others)").isEmpty()


def connected_components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(id, component) of every vertex that is not the smallest of its component; component is that smallest id.

    edges: columns a, b (long). Loops, nulls and repeated edges change nothing; no edges give no rows. Each round is two
    aggregates and two joins, until no vertex has two parents or is itself a parent's child; it is written into the shared folder, where only the last round's table stays; a vertex with very many edges only
    meets sums and joins that Spark can split. rows: about how many edges there are at most, if known. The number of rounds grows
    with the logarithm of the size of a component.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "components", rows)
    n = now.count()
    while not _is_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "components", n)
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, written(small.unionByName(first.select("u", F.col("m").alias("v"))).distinct(), "components", n)
        discard(before, large)
    out = now.distinct().select(F.col("u").alias("id"), F.col("v").alias("component"))
    out._written_at = now._written_at
    return out
