"""Manifests, tallies of reading units, review lists and evaluation reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.evidence import kappa, wilson
from foliospark.operators.numbering import running_sums
from foliospark.operators.search import rate_per_thousand
from foliospark.operators.selection import average_precision

# Runs and manifests


def run_manifest(rows: DataFrame) -> DataFrame:
    """One row: n rows, n_cases, the partitions present (sorted era|jurisdiction) and a digest of the distinct case ids by way of sorted hashes of 4,096 buckets, so no list of all ids is built."""
    cells = rows.agg(F.count("*").alias("n"), F.count_distinct("case_id").alias("n_cases"), F.array_sort(F.collect_set(F.concat_ws("|", "era", "jurisdiction"))).alias("partitions"))
    buckets = rows.groupBy((F.col("case_id") % 4096).alias("b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(F.col("case_id").cast("string"))), ","), 256).alias("h"))
    digest = buckets.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ","), 256).alias("digest"))
    return cells.crossJoin(digest)  # one row each


def gold_ids(gold: DataFrame) -> DataFrame:
    return gold.filter("case_id is not null").select("case_id").distinct()


def mean_scores(batches: DataFrame) -> DataFrame:
    """batch_id and the mean score of its cases (array; a null score is 0, no case is 0)."""
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return batches.select("batch_id", F.when(F.size("scores") > 0, total / F.size("scores")).otherwise(0.0).alias("mean"))


def pooled_cells(cases: DataFrame) -> DataFrame:
    """cell and mean of all its cases' scores, over cases and not batches."""
    return cases.groupBy("cell").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("mean"), F.count("*").alias("n"))


def chosen_cells(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Batches of the cells with the given keys; a key that no cell has fails the job."""
    wanted = batches.sparkSession.createDataFrame([(k,) for k in keys], "cell string")
    known = batches.select("cell", F.lit(True).alias("known")).distinct()
    bad = F.raise_error(F.concat(F.lit("no cell "), "cell")).cast("string")
    checked = wanted.join(known, "cell", "left").select(F.when(F.col("known"), F.col("cell")).otherwise(bad).alias("cell"))
    return batches.join(F.broadcast(checked), "cell", "left_semi")  # the keys of one call


def unit_tallies(reads: DataFrame) -> DataFrame:
    """unit_id with answered, relevant, irrelevant, accepted and lost counts of reads (unit_id, case_id, relevant, status), and completed (something was answered)."""
    lost = F.col("status").isin("missing", "failed")
    d = reads.groupBy("unit_id").agg(
        F.count_if(~lost).alias("answered"), F.count_if(~lost & F.col("relevant")).alias("relevant"), F.count_if(~lost & ~F.col("relevant")).alias("irrelevant"),
        F.count_if(F.col("status").isin("ok", "partial")).alias("accepted"), F.count_if(lost).alias("lost"),
    )
    return d.withColumn("completed", F.col("answered") > 0)


def merged_manifests(a: DataFrame, b: DataFrame) -> DataFrame:
    """Units of both manifests (unit_id, at, cases_read): the later row of a unit stays."""
    return a.unionByName(b).groupBy("unit_id").agg(F.max_by("cases_read", "at").alias("cases_read"), F.max("at").alias("at"))


def lost_cases(pool: DataFrame, answered: DataFrame) -> DataFrame:
    return pool.join(answered.select("case_id"), "case_id", "left_anti")


# Ledger reports


def counted(records: DataFrame) -> DataFrame:
    """Records that count: in the file, relevant, no parallel copy."""
    return records.filter("in_file and relevant and duplicate_of is null")


def cycle_manifest(admits: DataFrame) -> DataFrame:
    """case_id, cycle and outcome of the last admission of each case."""
    last = admits.groupBy("case_id").agg(F.max_by(F.struct("cycle", "relevant"), "seq").alias("l"))
    return last.select("case_id", "l.cycle", F.when(F.col("l.relevant"), "relevant").otherwise("irrelevant").alias("outcome"))


def admitted_by_cell(records: DataFrame) -> DataFrame:
    return records.groupBy("era", "jurisdiction").agg(F.count_if(F.col("relevant")).alias("relevant"), F.count_if(~F.col("relevant")).alias("irrelevant"))


# Review


def admitted_in_order(admits: DataFrame, run: str) -> DataFrame:
    """case_id and first admission seq of a run's cases."""
    return admits.filter(F.col("run_id") == run).groupBy("case_id").agg(F.min("seq").alias("seq"))


def checker_status(queue: DataFrame, responses: DataFrame) -> DataFrame:
    """case_id and the checker's status: ok, unparsed, failed or missing."""
    best = responses.groupBy("case_id").agg(F.min(F.when(F.col("status") == "ok", 0).when(F.col("status") == "unparsed", 1).otherwise(2)).alias("s"))
    return queue.select("case_id").join(best, "case_id", "left").select("case_id", F.when(F.col("s") == 0, "ok").when(F.col("s") == 1, "unparsed").when(F.col("s") == 2, "failed").otherwise("missing").alias("status"))


def suspects(records: DataFrame, pattern: str) -> DataFrame:
    """Records whose summary or notes match a case-insensitive pattern."""
    return records.filter(F.concat_ws(" ", "summary", "notes").rlike(f"(?i){pattern}"))


def last_human_decision(conflicts: DataFrame, decisions: DataFrame) -> DataFrame:
    """conflicts (case_id, field, seq) with the value of the last decision before them: on the field, else on any field of the case."""
    d = conflicts.select("case_id", "field", "seq", F.lit(None).cast("string").alias("value"), F.lit(True).alias("asks"))
    d = d.unionByName(decisions.select("case_id", "field", "seq", F.col("value").cast("string").alias("value"), F.lit(False).alias("asks")))
    last = lambda *by: F.last(F.when(~F.col("asks"), F.struct("value")), ignorenulls=True).over(Window.partitionBy(*by).orderBy("seq").rangeBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("own", last("case_id", "field")).withColumn("any", last("case_id")).filter("asks")
    return d.select("case_id", "field", "seq", F.when(F.col("own").isNotNull(), F.col("own.value")).otherwise(F.col("any.value")).alias("value"))


def balanced_parts(cards: DataFrame, n: int) -> DataFrame:
    """cards (card_id, size) with `part` 0 to n - 1: contiguous parts of about equal size, in order of card_id."""
    total = cards.agg(F.sum("size").alias("total"))  # one row
    d = running_sums(cards, [], [F.col("card_id")], {"upto": F.col("size")}).crossJoin(F.broadcast(total))
    return d.withColumn("part", F.floor((F.col("upto") - F.col("size")) * n / F.col("total")).cast("int")).drop("upto", "total")


# Evaluation


def agreement(decisions: DataFrame) -> DataFrame:
    """round, reader_a, reader_b, field, n, agreement, kappa and the Wilson bounds of each pair of readers, from decisions (round, case_id, reader, field, value)."""
    right = decisions.select("round", "case_id", "field", F.col("reader").alias("reader_b"), F.col("value").alias("b"))
    pairs = decisions.withColumnsRenamed({"reader": "reader_a", "value": "a"}).join(right, ["round", "case_id", "field"]).filter("reader_a < reader_b")
    out = kappa(pairs, ["round", "reader_a", "reader_b", "field"])
    w = wilson(F.round(F.col("agreement") * F.col("n")), F.col("n"))
    return out.withColumn("lo", w["lo"]).withColumn("hi", w["hi"])


def confusion(sample: DataFrame) -> DataFrame:
    """Counts of draw-time value by final value; a withdrawn record's final value is 'withdrawn'."""
    return sample.groupBy("drawn", F.when(F.col("withdrawn"), "withdrawn").otherwise(F.col("final")).alias("final")).agg(F.count("*").alias("n"))


def first_success(runs: DataFrame) -> DataFrame:
    """The first successful run of each case, or its first failed one if none was: case_id, run_id, status."""
    key = F.struct(F.col("status") != "ok", F.col("started"), F.col("run_id"))
    return runs.groupBy("case_id").agg(F.min_by(F.struct("run_id", "status"), key).alias("r")).select("case_id", "r.*")


def recall_by_tier(gold: DataFrame, hits: DataFrame) -> DataFrame:
    """tier, n, found and recall (3 places) of gold cases among hits."""
    d = gold.join(hits.select("case_id", F.lit(1).alias("hit")).distinct(), "case_id", "left")
    return d.groupBy("tier").agg(F.count("*").alias("n"), F.count("hit").alias("found"), F.round(F.count("hit") / F.count("*"), 3).alias("recall"))


def ranking_views(rows: DataFrame) -> DataFrame:
    """Average precision of all rows and of the reviewed view (reviewed rows and negatives)."""
    views = rows.withColumn("view", F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("reviewed") | (F.col("label") == 0), "reviewed")))))
    return average_precision(views, ["view"])


def ships(new: DataFrame, old: DataFrame, bar: float = 0.05) -> DataFrame:
    """One row: whether new is strictly better on every view, and whether by the bar at least."""
    d = new.join(old.select("view", F.col("ap").alias("before")), "view")
    return d.agg(F.every(F.col("ap") > F.col("before")).alias("ships"), F.every(F.col("ap") - F.col("before") >= bar).alias("clears_bar"))


# Answers


def quote_matches(records: DataFrame, terms: list[str]) -> DataFrame:
    """Records one of whose quotes holds a term as whole words; a final '*' lets the last word go on."""
    holds = lambda p: F.exists("quotes", lambda q: q.rlike(p))
    tests = [holds(_term(t)) for t in terms]
    return records.filter(reduce(lambda a, b: a | b, tests))


def _term(term: str) -> str:
    words = r"\s+".join(term.rstrip("*").lower().split())
    return rf"(?i)\b{words}" + ("" if term.endswith("*") else r"\b")


def concordance_answer(cases: DataFrame, hits: DataFrame, labels: list[str]) -> DataFrame:
    """label, era, jurisdiction, docs, matches and rate of each term for every cell of cases; hits: label, case_id. One scan of the cases, without their texts."""
    d = cases.select("case_id", "era", "jurisdiction").join(hits.groupBy("case_id").agg(F.collect_set("label").alias("found")), "case_id", "left")
    counts = d.groupBy("era", "jurisdiction").agg(F.count("*").alias("docs"), *(F.count_if(F.array_contains("found", k)).alias(f"n{i}") for i, k in enumerate(labels)))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("label"), F.col(f"n{i}").alias("matches")) for i, k in enumerate(labels))))
    out = counts.select("era", "jurisdiction", "docs", each.alias("t")).select("t.label", "era", "jurisdiction", "docs", "t.matches")
    return out.withColumn("rate", rate_per_thousand(F.col("matches"), F.col("docs")))


def concordance_earliest(cases: DataFrame, hits: DataFrame, n: int = 5) -> DataFrame:
    """label, rank, case_id, year, jurisdiction and cite: the n earliest dated hits of each term, by year and case_id."""
    d = cases.select("case_id", "year", "jurisdiction", "cite").filter("year is not null").join(hits, "case_id")
    d = d.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("year", "case_id"))).filter(F.col("rank") <= n)
    return d.select("label", "rank", "case_id", "year", "jurisdiction", "cite")


def spend(calls: DataFrame) -> DataFrame:
    """One row: cost, tokens and how many calls have no price."""
    return calls.agg(F.sum("cost").alias("cost"), F.sum("tokens").alias("tokens"), F.count_if(F.col("cost").isNull()).alias("unpriced"))


def outside_vocabulary(records: DataFrame, vocabularies: dict[str, list[str]]) -> DataFrame:
    """(case_id, field, value) of values that their vocabulary doesn't hold; null is always allowed."""
    bad: Column = F.array_compact(F.array(*(F.when(F.col(f).isNotNull() & ~F.col(f).isin(v), F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))) for f, v in vocabularies.items())))
    return records.select("case_id", F.explode(bad).alias("x")).select("case_id", "x.*")
