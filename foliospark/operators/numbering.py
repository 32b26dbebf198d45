"""Places and running sums in a sorted order, computed by ranges, so that neither one key nor a missing key puts all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.session import written


def running_sums(rows: DataFrame, by: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """rows with each of `sums` added up from the first row of its group `by` (null keys are one group) to the row itself, in `order`.

    Rows are dealt by ranges of (by, order) and written once, which fixes the division; a window then sees one group's rows of one range, and
    the sums of whole ranges are added to it. The order must tell all rows of a group apart, or equal rows take any order among themselves.
    """
    cut = rows.repartitionByRange(*(F.col(c) for c in by), *order).withColumn("__range", F.spark_partition_id())
    cut = written(cut.withColumns({f"__{k}": v for k, v in sums.items()}), "ranges")
    inside = Window.partitionBy("__range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = cut.groupBy("__range", *by).agg(*(F.sum(f"__{k}").alias(f"__{k}") for k in sums))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = whole.select(F.col("__range").alias("__at"), *(F.col(c).alias(f"__by_{c}") for c in by), *(F.coalesce(F.sum(f"__{k}").over(before), F.lit(0)).alias(f"__before_{k}") for k in sums))
    same = F.col("__range") == F.col("__at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    out = cut.withColumns({k: F.sum(f"__{k}").over(inside) for k in sums}).join(offsets, same)
    return out.withColumns({k: F.col(k) + F.col(f"__before_{k}") for k in sums}).select(*(c for c in rows.columns if c not in sums), *sums)


def numbered(rows: DataFrame, by: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """rows with their place, from 1, within their group in the order."""
    return running_sums(rows, by, order, {name: F.lit(1).cast("long")})
