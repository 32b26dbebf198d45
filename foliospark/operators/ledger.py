"""The append-only patch log: ids, sequence numbers, tallies. Folding is in `folding`.

A patch has seq, case_id, cycle, op (admit, set, append, drop_quote, migrate), field, new (JSON text), reviewer, model, prompt_version, run_id and rule_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.numbering import numbered

CONTENT = ("case_id", "cycle", "op", "field", "new", "reviewer", "model", "prompt_version", "run_id", "rule_id")


def patch_id(columns: tuple[str, ...] = CONTENT) -> Column:
    """The first 16 digits of the SHA-256 of a patch's content; nulls and empty texts differ."""
    return F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 16)


def new_patches(patches: DataFrame, log: DataFrame) -> DataFrame:
    """Patches, once each, whose content isn't in the log."""
    d = patches.withColumn("patch_id", patch_id()).dropDuplicates(["patch_id"])
    return d.join(log.select(patch_id().alias("patch_id")), "patch_id", "left_anti")


def numbered_patches(patches: DataFrame, head: int, *order: str) -> DataFrame:
    """patches with seq from head + 1 on in the order."""
    return numbered(patches, [], [F.col(c) for c in order], "seq").withColumn("seq", F.col("seq") + head)


def log_faults(log: DataFrame) -> DataFrame:
    """One row: head, n, and how many numbers of 1..head are missing or repeated."""
    d = log.agg(F.max("seq").alias("head"), F.count("*").alias("n"), F.count_distinct("seq").alias("k"))
    return d.select("head", "n", (F.col("head") - F.col("k")).alias("missing"), (F.col("n") - F.col("k")).alias("repeated"))


def kind() -> Column:
    """human, reader or rule: who a patch speaks for."""
    return F.when(F.col("reviewer").isNotNull(), "human").when(F.col("model").isNotNull(), "reader").when(F.col("rule_id").isNotNull(), "rule").otherwise("reader")


def last_values(patches: DataFrame) -> DataFrame:
    """(case_id, field, value) of the latest plain set of each field; valid where no protection or cascade applies."""
    return patches.filter("op = 'set'").groupBy("case_id", "field").agg(F.max_by("new", "seq").alias("value"))


def as_of(log: DataFrame, seq: int) -> DataFrame:
    return log.filter(F.col("seq") <= seq)


def protection_applies(log: DataFrame) -> DataFrame:
    """(case_id, field) on which a person's set comes before another's: where last_values may differ from fold."""
    w = Window.partitionBy("case_id", "field").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    d = log.filter("op = 'set'").withColumn("human_before", F.max((F.col("reviewer").isNotNull()).cast("int")).over(w))
    return d.filter("human_before = 1 and reviewer is null").select("case_id", "field").distinct()


def conflict_rows(conflicts: DataFrame, refused_only: bool = True) -> DataFrame:
    """The conflicts of a fold, those that were refused only, unless all are asked for."""
    return conflicts.filter("not historical") if refused_only else conflicts


def reviewed_ids(log: DataFrame) -> DataFrame:
    """Cases on which a person set or appended a judged field or the review's status."""
    from foliospark.operators.folding import JUDGED

    return log.filter(F.col("reviewer").isNotNull() & F.col("op").isin("set", "append") & F.col("field").isin(*JUDGED, "review.status")).select("case_id").distinct()


def tally(records: DataFrame, reviewed: DataFrame, by: list[str]) -> DataFrame:
    """human_reviewed and machine_only counts of the counted records by fields; the two are never added."""
    d = records.join(reviewed.select("case_id", F.lit(True).alias("h")), "case_id", "left")
    return d.groupBy(*by).agg(F.count_if(F.col("h")).alias("human_reviewed"), F.count_if(F.col("h").isNull()).alias("machine_only"))


def tally_with_total(records: DataFrame, reviewed: DataFrame, by: list[str]) -> DataFrame:
    """tally and, from the same pass, a row of all counted records: is_total tells it from a group whose fields are null."""
    d = records.join(reviewed.select("case_id", F.lit(True).alias("h")), "case_id", "left")
    counts = [F.count_if(F.col("h")).alias("human_reviewed"), F.count_if(F.col("h").isNull()).alias("machine_only")]
    return d.groupingSets([[F.col(c) for c in by], []], *(F.col(c) for c in by)).agg((F.grouping(by[0]) == 1).alias("is_total"), *counts)


def grid(records: DataFrame, reviewed: DataFrame, dims: dict[str, list[str]]) -> DataFrame:
    """tally over the full grid of the dims' values, zero-filled; records with values outside it keep rows of their own."""
    counts = tally(records, reviewed, list(dims))
    cells = None
    for name, values in dims.items():
        one = records.sparkSession.createDataFrame([(v,) for v in values], f"{name} string")
        cells = one if cells is None else cells.crossJoin(F.broadcast(one))  # lists of a few values
    return cells.join(counts, list(dims), "full").fillna(0, ["human_reviewed", "machine_only"])


def consensus(votes: DataFrame, k: int, vocabulary: list[str]) -> DataFrame:
    """(case_id, field, value) that k readers or more agree on: nulls are silent, ties go by text, values outside the vocabulary never win."""
    n = votes.filter("value is not null").groupBy("case_id", "field", "value").agg(F.count("*").alias("n"))
    best = n.groupBy("case_id", "field").agg(F.min(F.struct(-F.col("n"), F.col("value"), F.col("n").alias("m"))).alias("b"))
    return best.select("case_id", "field", F.when((F.col("b.m") >= k) & F.col("b.value").isin(vocabulary), F.col("b.value")).alias("value"))
